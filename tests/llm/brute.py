"""Plain Python versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def text_stats(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, inside, lines, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            inside.update(range(i, i + 8))
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def base_spans(text):
    text = text or ""
    assign = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out))


def line_key(line):
    return line.strip(BLANKS).translate(LOWER)


def dedup_lines(docs):
    """(n_lines, n_dropped, text) by position for (doc_id, text) rows; None ids are one smallest document."""
    held = defaultdict(set)
    rank = lambda i: -math.inf if i is None else i
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= 40:
                held[line_key(line)].add(rank(i))
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(line_key(x)) >= 40 and len(held[line_key(x)]) >= 5 and rank(i) != max(held[line_key(x)]))]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text):
    words = WORD.findall(text or "")
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similar(docs, threshold=0.8):
    """(class_id, n_links) by position."""
    sets = [shingles(t) for _, t in docs]
    n = len(docs)
    links = [[j for j in range(n) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [docs[j][0] for j in seen if docs[j][0] is not None]
        out.append((min(ids) if ids else None, len(links[i])))
    return out


def base_scores(docs):
    """doc position -> (held_out, n_tokens, n_known, train tokens, base score)."""
    tokens = [WORD.findall((t or "").translate(LOWER)) + [None] for _, t in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in docs]
    count = Counter(w for h, ws in zip(held, tokens) if not h for w in ws)
    total = sum(count.values())
    bottom = math.log10(total + 0.1 * (len(count) + 1))
    return [(h, len(ws), sum(count[w] > 0 for w in ws), total, sum(math.log10(count[w] + 0.1) - bottom for w in ws)) for h, ws in zip(held, tokens)]
