"""Phrases, url filter and fill-in-the-middle against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict
from urllib.parse import urljoin

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from seamark.llm import middle, phrases, queries, urls


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# Phrases ------------------------------------------------------------------------------------


def mined(rows, least, cover=100, top=2000, longest=5):
    """(lang, rank, phrase, a, l, r, n, score) by the definition, for (lang, text) rows."""
    count, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(brute.LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                count[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {q for p, a in found.items() for size in range(2, len(p)) for q in (p[i : i + size] for i in range(len(p) - size + 1)) if 100 * a >= cover * found[q]}
        scored = []
        for p, a in found.items():
            score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if p not in covered:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("least, cover, top, shard", [(3, 100, 2000, 1 << 20), (5, 60, 7, 300), (2, 100, 2000, 1)])
def test_phrases(docs, rows, least, cover, top, shard, monkeypatch):
    """Also over many small shards (the tasks run in this module's own copy, so the size is passed by the closure)."""
    from pyspark.sql import functions as F

    langs = F.expr("CASE WHEN doc_id % 3 = 0 THEN 'en' WHEN doc_id % 3 = 1 THEN 'fr' END")
    texts = docs.filter("doc_id IS NULL OR doc_id NOT IN (8, 9, 302)").withColumn("lang", langs)
    plain = [((None, "en", "fr")[0 if i is None else (1 if i % 3 == 0 else 2 if i % 3 == 1 else 0)], t) for i, t in rows if i not in (8, 9, 302)]
    got = phrases.collocations(texts.repartition(1 if shard == 1 << 20 else 7), least, cover, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = mined(plain, least, cover, top)
    assert len(want) > 10 and collected(got) == want


def test_phrases_of_nothing(docs, empty):
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(docs, least=10**9).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60))
def test_intervals_count_every_phrase(ids):
    """All phrases of the bidirectional index, against a count of the ids."""
    shard = phrases.Shard("en", phrases.packed(np.array([0, *ids, 0], "<i4")), phrases.packed(b"\n".join(b"%d" % i for i in range(1, 5))))
    want = Counter(tuple(ids[i : i + n]) for n in (1, 2, 3, 4, 5) for i in range(len(ids) - n + 1) if 0 not in ids[i : i + n])
    words = lambda size: {p: c for p, c in want.items() if len(p) in size}
    hashed = lambda p: int(shard.phrase(np.array([p]), len(p))[0])
    keys, counts = phrases.pairs(shard)
    short = dict(zip(keys.tolist(), counts.tolist()))
    total = short.pop(int(shard.total()[0]))
    assert total == sum(i > 0 for i in ids) and short == {hashed(p): c for p, c in words((1, 2)).items()}
    frequent = {p for p, c in words((2,)).items() if c > 1}
    keys, counts = phrases.longer(shard, np.array(sorted(map(hashed, frequent)), np.uint64))
    assert dict(zip(keys.tolist(), counts.tolist())) == {hashed(p): c for p, c in words((3, 4, 5)).items() if all(q in frequent for q in zip(p, p[1:]))}


def test_scores_do_not_overflow():
    shard = phrases.Shard("en", phrases.packed(np.array([0, 1, 2, 0], "<i4")), phrases.packed(b"x\ny"))
    keys = np.concatenate([shard.total(), shard.phrase(np.array([[1], [2]]), 1), shard.phrase(np.array([[1, 2]]), 2)])
    totals = np.array([10**17, 10**12, 10**12 + 1, 10**12 - 7])
    order = np.argsort(keys)
    (row,) = [r for part in phrases.spelt("en", shard, keys[order], totals[order], np.ones(4, bool)) for r in part]
    assert row[6:] == (10**12 - 7, 10**12, 10**12 + 1, 10**17, 1000 * (10**12 - 7) * 10**17 // (10**12 * (10**12 + 1)))


# Urls ---------------------------------------------------------------------------------------

PAGES = [
    (1, "http://a.net/de/1", None),
    (2, "https://www.a.net/de/1?utm_source=feed", '<link rel="canonical" href="/es/9">'),
    (3, "http://b.org/x", "<LINK href='http://a.net/de/1' REL=\"nofollow Canonical\">"),
    (4, "http://c.org/y", '<meta content="3; URL=http://b.org/x" http-equiv="Refresh">'),
    (5, "http://d.org/y", '<!-- <link rel="canonical" href="http://b.org/x"> --><script>"<link rel=canonical href=http://b.org/x>"</script><link rel="icon" href="http://b.org/x">'),
    (6, "http://X.example.com/en/q", None),
    (7, "http://e.org/1", '<link rel=canonical href="http://x.example.com/en/q">'),
    (8, "http://e.org/2", '<link rel=canonical href="http://e.org/1"><meta http-equiv=refresh content="0;url=\'http://www.example.com/en/z\'">'),
    (9, None, '<link rel="canonical" href="http://b.org/x">'),
    (10, "no scheme", ""),
    (11, "://", ""),
    (12, "http://www.example.com/en/z", "<p>"),
    (13, "http://com:80/a", ""),
    (14, "http://com", ""),
    (None, "HTTP://COM/#f?", ""),
    (15, "http://net/es/", ""),
    (16, "http://f.org/?a=1&ref=z&b=2&utm_x=", '<link rel=canonical href="//net/fr/?u&amp;v">'),
    (17, "https://f.org?a=1&b=2", ""),
    (4, "http://c.org/y", '<meta content="3; URL=http://b.org/x" http-equiv="Refresh">'),
    (18, "http://g.org/dir/page", '<link rel=canonical href="other">'),
    (19, "http://g.org/dir/other/", '<link rel=canonical href="http://[bad">'),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "h", "v", 1) for p in PAGES], "page_id long, url string, html string, host string, verdict string, class int").repartition(3)


def parts(url):
    found = re.match("(?s).*?://([^/?#]*)([^?#]*)([^#]*)", url or "")
    return (found[1].translate(brute.LOWER), found[2], found[3]) if found else ("", "", "")


def own_rule(host, path):
    fits = [(len(r), v, r) for v, r in queries.RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def judged(pages, redirects=()):
    edges = list(redirects)
    for _, url, html in pages:
        shown = re.sub("(?is)<!--.*?-->|<script.*?</script>", "", html or "")
        for tag in re.findall("(?is)<(?:link|meta)[^>]*>", shown) if url else ():
            goal = None
            if tag[:5].lower() == "<link" and re.search("(?i)canonical", tag):
                goal = re.search("(?i)href=[\"']?([^\"'> ]*)", tag)[1].replace("&amp;", "&")
            elif re.search("(?i)refresh", tag):
                goal = re.search("(?i)url='?([^\"'> ]*)", tag)[1]
            if goal and "[bad" not in goal:
                edges.append((url, urljoin(url, goal)))
    name = lambda u: "".join(parts(u))
    near = defaultdict(set)

    def link(a, b):
        near[a].add(b)
        near[b].add(a)

    for a, b in edges:
        link(name(a), name(b))
    for node in {name(u) for _, u, _ in pages if parts(u)[0]} | {name(b) for _, b in edges}:
        place, _, query = node.partition("?")
        if re.match("(www|m)[.][^/]*[.]", place):
            place = place.split(".", 1)[1]
        query = "&".join(x for x in query.split("&") if x and not re.match("(utm_[a-z]+|ref|fbclid|gclid)=", x))
        link(node, place.removesuffix("/") + ("?" + query if query else ""))

    def verdict(url):
        seen, todo = {name(url)}, [name(url)]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        found = {own_rule(*parts("x://" + x)[:2])[0] for x in seen}
        return "block" if "block" in found and "allow" not in found else "allow"

    out = []
    for i, url, _ in pages:
        host, path, _ = parts(url)
        own, rule = own_rule(host, path)
        out.append((i, host, path, rule, own or (verdict(url) if host else "allow")))
    return sorted(out, key=str)


def test_urls(spark, pages):
    want = judged(PAGES)
    got = urls.judge(pages, queries.RULES).select("page_id", "host", "path", "rule", "verdict")
    assert collected(got) == want
    verdict = {r[0]: r[4] for r in want}
    # 1 to 4 hang together and 2 names a blocked page; 5 only shows links; 7 and 8 hang on a blocked and on an allowed page.
    assert [verdict[i] for i in (1, 2, 3, 4, 5, 6, 7, 8, 12, 16, 17)] == ["block"] * 4 + ["allow", "block", "allow", "allow", "allow", "block", "block"]
    assert urls.judge(pages.limit(0), queries.RULES).count() == 0
    assert {r.verdict for r in urls.judge(pages, []).collect()} == {"allow"}


def test_known_redirects_join_classes(spark, pages):
    known = [("http://d.org/y", "https://h.net/fr/1#x"), ("http://d.org/z", None)]
    got = urls.judge(pages, queries.RULES, spark.createDataFrame(known, "from_url string, to_url string")).select("page_id", "host", "path", "rule", "verdict")
    want = judged(PAGES, known[:1])
    assert collected(got) == want and dict((r[0], r[4]) for r in want)[5] == "block"


def test_hubs_and_chains(spark):
    """A hub of many aliases and a long chain, each with one blocked end."""
    hub = [(i, f"http://s{i}.org/", '<link rel=canonical href="http://hub.net/de/">') for i in range(1500)]
    chain = [(5000 + i, f"http://c{i}.org/", f'<link rel=canonical href="http://c{i + 1}.org/">') for i in range(12)]
    pages = spark.createDataFrame([*hub, *chain, (1, "http://hub.net/de/", '<link rel=canonical href="/es/1">'), (2, "http://c12.org/", '<link rel=canonical href="http://z.net/fr/">')], "page_id long, url string, html string")
    got = urls.judge(pages, queries.RULES)
    assert got.count() == 1514 and {r.verdict for r in got.collect()} == {"block"}


def test_longest_rule_wins_and_ties_follow_the_host(spark):
    rules = [("block", "b.c/aaaa"), ("allow", "a.b.c/aa"), ("block", "c/"), ("allow", "C/AAAAAA")]
    pages = spark.createDataFrame([(1, "x://a.b.c/aaaaaa", None), (2, "x://b.c/aaaaaa", None), (3, "x://c/AAAAAA?", None)], "page_id long, url string, html string")
    assert [r.rule for r in urls.judge(pages, rules).orderBy("page_id").collect()] == ["a.b.c/aa", "b.c/aaaa", "C/AAAAAA".replace("C/", "c/")]


# Fill in the middle -------------------------------------------------------------------------


def in_form(doc_id, text):
    text = text or ""
    units = re.findall("[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_the_middle(spark, docs, rows, empty, counted):
    made = middle.transform(docs)
    assert made.columns == [*docs.columns, "output", "form", "n", "prefix_chars", "middle_chars"]
    want = counted([in_form(i, t) for i, t in rows])
    assert collected(made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert collected(middle.restore(made).select("doc_id", "restored")) == counted([(t or "",) for _, t in rows])
    assert middle.restore(middle.transform(empty)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab<>PSM\né🙂"), max_size=40), st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)))
def test_any_text_comes_back(text, doc_id):
    output, form, n, first, mid = middle.into_form(text.encode(), doc_id)
    assert (n, form, first, mid, bytes(output).decode()) == in_form(doc_id, text)
    assert bytes(middle.out_of_form(bytes(output), form)).decode() == text


def test_share_of_texts_that_stay_plain():
    forms = Counter(middle.into_form(b"a\nb\nc", i, rate=30, spm_rate=0)[1] for i in range(2000))
    assert 500 < forms["psm"] < 700 and forms["spm"] == 0


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=50), st.integers(0, 50), st.integers(0, 50), st.integers(0, 50))
def test_rotation(data, a, b, c):
    a, b, c = sorted(min(x, len(data)) for x in (a, b, c))
    chunk, middle.CHUNK = middle.CHUNK, 3
    buffer = bytearray(data) or bytearray(b"x")
    want = bytes(buffer[:a] + buffer[b:c] + buffer[a:b] + buffer[c:])
    middle.rotate(buffer, a, b, c)
    middle.CHUNK = chunk
    assert bytes(buffer) == want
