"""Similarity join, packing, archives, vector search and rollups, against plain Python."""

import hashlib
import math
import random
import uuid
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from seamark.llm import ann, graphs, neardup, packing, rollup, warc
from seamark.llm.common import fresh_dir, shared_dir

BPE = public_tokenizers.path("byte_bpe_50k.json")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_bands_reach_their_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = neardup.bands_for(threshold, 0.99, 200)
        assert bands * rows <= 200 and 1 - (1 - threshold**rows) ** bands >= 0.99


def test_similar(docs, rows, empty, counted):
    want = [(c if c is not None else i, n) for (i, _), (c, n) in zip(rows, brute.similar(rows))]
    assert sum(n > 0 for _, n in want) > 30
    assert collected(neardup.similar(docs)) == counted(want)
    assert neardup.similar(empty).count() == 0


def test_similar_over_blocks(docs, rows, counted, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 2)
    want = [(c if c is not None else i, n) for (i, _), (c, n) in zip(rows, brute.similar(rows))]
    assert collected(neardup.similar(docs)) == counted(want)


def test_groups_count_every_link_once(monkeypatch):
    """A large group of near copies in tiles and blocks, against all pairs."""
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = []
    for _ in range(150):
        s = base.copy()
        s[rng.choice(400, rng.integers(0, 60), replace=False)] = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
        sets.append(np.unique(s))
    to = np.cumsum([0] + [len(s) for s in sets])
    sig = neardup.minhashes(np.concatenate(sets), to)
    size = rng.integers(1, 5, 150)
    block = rng.integers(0, 3, 150).astype(np.int32)
    monkeypatch.setattr(neardup, "TILE", 16)
    links, up = Counter(), list(range(150))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for lo in range(3):
        for hi in range(lo, 3):
            own = [i for i in range(150) if block[i] in (lo, hi)]
            table = pa.table({"h1": own, "size": size[own], "block": block[own], "lo": [lo] * len(own), "hi": [hi] * len(own), "sig": [sig[i].tobytes() for i in own], "shingles": [sets[i].tobytes() for i in own]})
            for r in neardup.verified(table).to_pylist():
                links[r["h1"]] += r["links"]
                a, b = root(r["h1"]), root(r["root"])
                up[max(a, b)] = min(a, b)
    jaccard = lambda a, b: len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    near = np.array([[i != j and jaccard(a, b) >= 0.8 for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    assert [links[i] for i in range(150)] == (near @ size).tolist()
    assert len({root(i) for i in np.flatnonzero(near.any(axis=1))}) == 1


def test_keep_one_of_each_class(docs, rows):
    kept = [r.doc_id for r in neardup.keep_one(docs).collect()]
    classes = brute.similar(rows)
    want = sorted({i for (i, t), (c, _) in zip(rows, classes) if i is not None and (c is None or c == i or not brute.shingles(t))})
    assert sorted(i for i in kept if i is not None) == want
    assert kept.count(None) == sum(i is None for i, _ in rows)
    assert neardup.keep_one(docs).columns == docs.columns


def test_keep_one_keeps_unlike_texts_that_share_a_doc_id(spark):
    text = lambda k: " ".join(f"{k}word{i}" for i in range(60))
    rows = [(3, text("a")), (7, text("a")), (7, text("b")), (7, text("c")), (7, text("c") + " end"), (8, text("d")), (8, text("e")), (8, text("e")), (9, ""), (9, None), (9, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).persist()
    kept = [(r.doc_id, (r.text or "").split("word")[0].strip()) for r in neardup.keep_one(docs).collect()]
    assert sorted(kept) == [(3, "a"), (7, "b"), (7, "c"), (8, "d"), (8, "e"), (9, ""), (9, "")]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 130)]
    got = {r.a: r.b for r in graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert got.get(start, start) == min(seen)


def test_encoder_is_the_library(rows):
    enc = packing.Encoder(BPE)
    rng = random.Random(6)
    pieces = ["a", "the", "  ", "\n", "\r\n", "\t", "\x85", "\xa0", " ", "'s", "'ll", "!", "12", "é", "中文", "\x1c", "᠎", "🙂", "   ", "x" * 30, "<|endoftext|>"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [t or "" for _, t in rows]
    for text, ids in zip(texts, enc.ids(texts)):
        assert ids == np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_special_token_in_a_text_is_one_id():
    """Against an untouched tokenizer, with the literal alone, beside and within words."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BPE)
    mark = "<|endoftext|>"
    texts = [mark, f"{mark}{mark}", f"a {mark} b", f"word{mark}word", f"a\n{mark}\nb c", f" {mark}  x", f"<|endoftext{mark}|>", f"<|endoftext |> the {mark[:-1]}", f"x{mark}", "no mark here"]
    for text, ids in zip(texts, packing.Encoder(BPE).ids(texts)):
        want = plain.encode(text, add_special_tokens=False).ids
        assert ids == np.array(want, "<u4").tobytes() and want.count(50256) == text.count(mark)


def test_memo_is_bounded(monkeypatch, rows):
    monkeypatch.setattr(packing, "MEMO", 50)
    enc = packing.Encoder(BPE)
    for _, text in rows:
        assert enc.ids([text or ""])[0] == np.array(enc.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()
        assert len(enc.memo) <= 50


@pytest.mark.parametrize("seed", range(20))
def test_plan_holds_every_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 50, 2048])
    counts = {rng.randint(1, capacity): rng.randint(1, 300) for _ in range(rng.randint(1, 200))}
    patterns = packing.plan(counts, capacity)
    held = Counter()
    for pattern, times in patterns:
        assert sum(pattern) <= capacity and times > 0
        for length in pattern:
            held[length] += times
    assert held == counts
    floor = -(-sum(k * v for k, v in counts.items()) // capacity)
    large = sum(v for k, v in counts.items() if 2 * k > capacity)
    assert sum(m for _, m in patterns) <= max(1.25 * floor + 2, large + 0.25 * floor + 2)


def test_exact_complements_come_first():
    assert sorted(packing.plan({1500: 3, 548: 3, 1000: 2, 600: 2, 448: 2, 1024: 4}, 2048)) == [((1000, 600, 448), 2), ((1024, 1024), 2), ((1500, 548), 3)]
    assert packing.plan({1000: 1, 500: 1, 300: 1, 248: 1}, 2048) == [((1000, 500, 300, 248), 1)]


def check_packed(packed, texts, capacity=2048):
    """``packed`` rows against the ids of ``texts``, a list of (doc_id, text)."""
    tokenizer = packing.Encoder(BPE).tokenizer
    want, total = [], 0
    for i, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed), key=str) == sorted(want, key=str)
    place = defaultdict(list)
    for r in packed:
        place[r.sequence_id].append((r.offset, r.length))
    for held in place.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(place), -(-total // capacity)


def test_pack(docs, rows, empty):
    used, floor = check_packed(packing.pack(docs, BPE).collect(), rows)
    assert used <= 1.03 * floor + 1
    assert packing.pack(empty, BPE).count() == 0


def test_pack_ranks_over_buckets(docs, rows, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 7)
    check_packed(packing.pack(docs, BPE).collect(), rows)


PAGES = [
    (1, "http://a b\n", "x" * 200),
    (2, None, "x" * 200),
    (2, None, "x" * 200),
    (2, "q", "y" * 300),
    (None, "u", "x" * 200),
    (None, "u", "only nulls " * 20),
    (3, "v", None),
    (4, "w", "z" * 50),
    (5, "w", "z" * 50),
    (6, "", "é" * 60),
    (7, "", "é" * 60),
    (8, "big", "<p>\r\n\r\nWARC/1.1\r\n</p>" * 40_000),
    (9, "big", "<p>\r\n\r\nWARC/1.1\r\n</p>" * 40_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x", 1, "y") for p in PAGES], "page_id long, url string, html string, digest string, kind int, refers_to string").repartition(3)


def expected_records(pages):
    first = {}
    for i, _, html in pages:
        if i is not None:
            first[html] = min(i, first.get(html, i))
    out = []
    for i, _, html in pages:
        payload = (html or "").encode()
        again = len(payload) >= 100 and html in first and i != first[html]
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("roll", [1, 600, 1 << 20])
def test_warc_round_trip(spark, pages, roll):
    root = fresh_dir(spark, "warc")
    listed = warc.write(pages, root, roll)
    got = warc.read(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert collected(got) == expected_records(PAGES)
    assert listed.agg({"records": "sum"}).first()[0] == len(PAGES)
    fs, path = warc.filesystem(root)
    for r in listed.collect():
        raw = fs.open_input_stream(f"{path}/{r.name}").readall()
        assert (len(raw), hashlib.sha256(raw).hexdigest()) == (r.bytes, r.sha256)


def test_warc_is_deterministic_and_sorted(spark, pages):
    sums, order = [], []
    for _ in range(2):
        root = fresh_dir(spark, "warc")
        sums.append(sorted((r.shard, r.file, r.sha256) for r in warc.write(pages.coalesce(1), root, 600).collect()))
        fs, path = warc.filesystem(root)
        order = [warc.parse(raw)[0].get("X-Page-ID") for r in sorted(warc.manifest(spark, root).collect()) for raw in warc.members(fs.open_input_stream(f"{path}/{r.name}")) if b"WARC-Type: warcinfo" not in raw[:60]]
    assert sums[0] == sums[1]
    ids = [int(i) for i in order if i is not None]
    assert ids == sorted(ids) and order[:2] == [None, None]


def test_warc_shards_follow_the_pages_alone(spark, monkeypatch):
    """The same files whatever the partitions, with a page_id larger than a shard, rows without one and far ids."""
    monkeypatch.setattr(warc, "LEAST_SHARD", 8 << 10)
    rng = random.Random(4)
    ids = [*range(0, 5000, 10), *[77] * 60, *[None] * 60, -(2**62), 2**62, 2**62 + 1]
    rows = [(i, f"http://x/{i}", "".join(rng.choices("abc <>", k=rng.randint(0, 900)))) for i in ids]
    rows += rows[::50]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    begin, first = warc.starts(pages)
    assert first > 1 and (begin == 77).sum() > 1 and len(begin) > 20 and (np.diff(begin) >= 0).all()
    listed = []
    for dealt in (pages.repartition(7), pages.orderBy("html").coalesce(2), pages.repartition(3, "url")):
        root = fresh_dir(spark, "warc")
        listed.append(sorted(tuple(r) for r in warc.write(dealt, root).collect()))
        assert Counter(r.page_id for r in warc.read(spark, root).collect()) == Counter(i for i, _, _ in rows)
        fs, path = warc.filesystem(root)
        names = [r.name for r in warc.manifest(spark, root).collect()]
        found = [warc.parse(raw)[0]["WARC-Record-ID"] for n in names for raw in warc.members(fs.open_input_stream(f"{path}/{n}"))]
        assert len(found) == len(set(found))
    assert listed[0] == listed[1] == listed[2]
    assert max(r[3] for r in listed[0]) < 60


def test_warc_reads_only_what_is_committed_and_finds_damage(spark, pages):
    root = fresh_dir(spark, "warc")
    warc.write(pages, root)
    fs, path = warc.filesystem(root)
    with fs.open_output_stream(f"{path}/stray.warc.gz") as out:
        out.write(b"not an archive")
    assert warc.read(spark, root).count() == len(PAGES)
    raw = warc.page_record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), 0, None)
    with pytest.raises(ValueError):
        warc.read_record(zlib.decompress(raw, 31).replace(b"payload", b"paYload"))
    with pytest.raises(EOFError):
        import io

        list(warc.members(io.BytesIO(raw[:-12])))
    nothing = fresh_dir(spark, "warc")
    warc.write(pages.limit(0), nothing)
    assert warc.read(spark, nothing).count() == 0


def exact_neighbours(vectors, top=20):
    good = {}
    for i, v in vectors:
        if i is not None and v is not None and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, float)
    out = {}
    for i in good:
        if i % 20 == 0:
            near = sorted((-(good[j] @ good[i]), j) for j in good if j != i)[:top]
            out[i] = [(j, -s) for s, j in near]
    return out


def test_vector_search_on_awkward_rows(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(200)]
    vectors += [(200, None), (220, [0.0] * 4), (240, [1.0, None, 2.0, 3.0]), (260, [1.0, float("nan"), 0.0, 0.0]), (280, [float("inf"), 0.0, 0.0, 1.0]), (300, [1.0, 2.0]), (None, [1.0] * 4)]
    vectors += [(400 + i, [3.0, 3.0, 3.0, 3.0]) for i in range(90)] + [vectors[20], vectors[21]]
    df = spark.createDataFrame([(*v, 1, "k") for v in vectors], "vec_id long, embedding array<float>, key int, leaf string")
    got = defaultdict(list)
    for r in ann.search(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = exact_neighbours(vectors)
    assert set(got) == set(want)
    for i in want:
        assert got[i] == want[i]


def test_vector_search_recall_and_few_candidates(spark, sf_dir, monkeypatch):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    monkeypatch.setattr(ann, "LEAF_POINTS", 16)
    monkeypatch.setattr(ann, "BLOCK", 10)
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in vectors.collect()]
    found = defaultdict(set)
    for r in ann.search(vectors).collect():
        found[r.query_id].add(r.vec_id)
    hit = total = 0
    for i, v in rows:
        if i % 20 == 0:
            near = sorted((-(w @ v), j) for j, w in rows if j != i)[:20]
            hit += len(found[i] & {j for _, j in near})
            total += 20
    assert hit / total >= 0.9
    few = ann.search(vectors.filter("vec_id < 3")).collect()
    assert [(r.query_id, r.rank) for r in few] == [(0, 1), (0, 2)]
    assert ann.search(vectors.limit(0)).count() == 0


def test_leaf_visits_follow_the_distance():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 8))
    tree = ann.Tree(float((x * x).sum(axis=1).max()))
    lifted = tree.lifted(x)
    tree.grow(lifted, 50, rng)
    leaf = tree.assign(lifted)
    assert len(np.unique(leaf)) == tree.leaves
    sizes = np.bincount(leaf, minlength=tree.leaves)
    order = tree.visits(np.append(x[0], 0.0), tree.leaves, sizes)
    assert sorted(order) == list(range(tree.leaves))
    best = np.argsort(-(x @ x[0]))[:20]
    assert np.median([order.index(leaf[i]) for i in best]) < tree.leaves / 4


CHANGE = "action string, source string, lang string, version string, n_tokens long, old_tokens long, n_docs string"


def test_rollup(spark):
    store = rollup.Rollup(spark, fresh_dir(spark, "rollup"))
    assert store.totals().count() == 0
    first = spark.createDataFrame([("insert", "a", "en", "v1", 5, None, "x"), ("insert", "a", "en", "v1", 7, None, "x"), ("insert", None, None, "v1", None, None, "x"), ("insert", "b", "de", "v1", 3, None, "x"), ("insert", "b", "de", "v1", 3, None, "x")], CHANGE)
    second = spark.createDataFrame([("delete", "a", "en", "v1", 5, None, "x"), ("revise", "b", "de", "v1", 10, 3, "x"), ("revise", "b", "de", "v1", 1, 3, "x"), ("insert", "a", "en", "v2", 9, None, "x")], CHANGE)
    assert store.commit("one", first) and not store.commit("one", second)
    assert store.compact()
    assert store.commit("two", second) and not store.commit("two", second) and not store.commit("one", first)
    want = [("a", "en", "v1", 1, 7), ("a", "en", "v2", 1, 9), ("b", "de", "v1", 2, 11), (None, None, "v1", 1, 0)]
    assert collected(store.totals()) == sorted(want, key=str)
    assert store.compact() and collected(store.totals()) == sorted(want, key=str)
    gone = spark.createDataFrame([("delete", "a", "en", "v2", 9, None, "x")], CHANGE)
    assert store.commit("three", gone) and store.commit("four", gone.limit(0))
    assert collected(store.totals()) == sorted((w for w in want if w[2] == "v1"), key=str)
    assert store.committed() == ["four", "one", "three", "two"]


def test_rollup_writer_lost_before_its_commit(spark, monkeypatch):
    """A writer that dies between writing and renaming commits nothing; the batch can be sent again."""
    store = rollup.Rollup(spark, fresh_dir(spark, "rollup"))
    rows = spark.createDataFrame([("insert", "s", "en", "v", 5, None)], "action string, source string, lang string, version string, n_tokens long, old_tokens long")
    assert store.commit("b0", rows)

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(rollup.Rollup, "_rename", lost)
        with pytest.raises(KeyboardInterrupt):
            store.commit("b1", rows)
    assert store.committed() == ["b0"] and store.totals().first()["n_tokens"] == 5
    assert store.commit("b1", rows) and not store.commit("b1", rows)
    # Two writers that both saw a free name: the second finds it taken and changes nothing.
    assert not store._create("commits/b1", {"data": "none"})
    assert store.committed() == ["b0", "b1"] and store.totals().first()["n_tokens"] == 10
    assert store.compact() and store.totals().first()["n_tokens"] == 10


def test_rollup_ignores_data_without_a_commit(spark):
    store = rollup.Rollup(spark, fresh_dir(spark, "rollup"))
    rows = spark.createDataFrame([("insert", "a", "en", "v1", 5, None, "x")], CHANGE)
    store._data(rollup.signed(rows))
    assert store.totals().count() == 0
    with pytest.raises(Exception, match="unknown action"):
        store.commit("bad", spark.createDataFrame([("upsert", "a", "en", "v1", 5, None, "x")], CHANGE))
    assert store.committed() == [] and store.commit("good", rows)
    with pytest.raises(ValueError):
        store.commit("../x", rows)


def test_shared_folder_is_the_named_one(spark):
    assert fresh_dir(spark, "x").startswith(shared_dir(spark)) and str(uuid.UUID(fresh_dir(spark, "x")[-32:]))
