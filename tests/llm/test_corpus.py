"""Operators over many documents against brute force: near duplicates, repeated passages,
packing, toxicity, rollups, and the pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from zonecast.llm import graph, minhash, packing, rollups, substring, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF01 = "/root/testdata/sf0.01"


def corpus(seed=1):
    """Originals, exact and near copies, shared passages, repetitive and tiny texts."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    fresh = lambda n: [rng.choice(vocab) for _ in range(n)]
    out, passage = [], fresh(70)
    for k in range(25):
        base = fresh(rng.randint(20, 160))
        out.append(base)
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            out.append(copy)
        if k % 4 == 0:
            cut = rng.randint(0, 15)
            out.append(fresh(10) + passage[cut:cut + rng.randint(49, 55)] + fresh(10))
    out += [["ber"] * 120, ["Ber"] * 90, ["x"], ["X"], ["x", "y"], [], []]
    rng.shuffle(out)
    rows = [(i, " ".join(w)) for i, w in enumerate(out)]
    return rows + [(len(rows), None), (len(rows) + 1, rows[3][1].replace(" ", "\n")), (len(rows) + 2, " \t ")]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "own", "own") for i, t in rows], "doc_id long, text string, `set` string, n_words string")


def shingles(t, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, docs, rows, k):
    sets = {i: shingles(t, k) for i, t in rows}
    comp = {i: i for i in sets}
    for a in sorted(sets):  # label propagation over all pairs
        for b in sets:
            inter = len(sets[a] & sets[b])
            if a != b and sets[a] and sets[b] and 100 * inter >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((comp[a], comp[b]))
                comp = {i: lo if c == hi else c for i, c in comp.items()}
    got = {r.doc_id: r for r in minhash.near_duplicates(docs, k=k).collect()}
    assert {i: r.component_id for i, r in got.items()} == comp
    assert all(r.n_shingles == len(sets[i]) and r.kept == (comp[i] == i) for i, r in got.items())
    assert minhash.near_duplicates(docs.limit(0), k=k).count() == 0


def test_boilerplate_meets_only_where_it_can_be_linked(spark):
    """Texts of common and own words share buckets without being near copies; planted near
    copies among them, some linked over a third text only, are found as brute force finds them."""
    rng = random.Random(5)
    common = [f"c{i}" for i in range(60)]
    texts = []
    for i in range(120):
        base = common + [f"o{i}_{j}" for j in range(rng.choice([14, 20, 25]))]
        texts.append(base)
        for step in range(rng.choice([0, 0, 1, 3])):       # a chain: each copy differs a little from the last
            base = base[:-4] + [f"n{i}_{step}_{j}" for j in range(4)]
            texts.append(base)
    rng.shuffle(texts)
    sets = [{tuple(w[i:i + 2]) for i in range(len(w) - 1)} for w in texts]
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(texts)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, k=2).collect()}
    assert got == {i: find(i) for i in range(len(texts))}


def test_near_duplicates_odd_ids(spark):
    df = spark.createDataFrame([(None, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "e f g h"), (2, "a b c d"), (None, "q r s t"), (None, None)],
                               "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df, k=2).collect()), key=str)
    assert len(got) == 7 and got.count((1, 1, True)) == 2 and (None, None, True) in got and (None, 1, False) in got


def test_circulant_signature():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-2**62, 2**62, 400), rng.integers(-2**62, 2**62, 400)
    b[:320] = a[:320]
    values = np.concatenate([a, b, a])
    sig = minhash.signatures(values, np.array([0, 400, 800]), 512)
    assert (sig[0] == sig[2]).all() and abs((sig[0] == sig[1]).mean() - 320 / 480) < 0.1
    x = np.arange(100, dtype=np.uint32)
    assert len(set(minhash.mix32(x.copy()).tolist())) == 100
    big = rng.integers(-2**62, 2**62, 3 * minhash.BLOCK)  # a set over several blocks
    one = minhash.signatures(big, np.array([0]), 64)
    two = np.minimum(minhash.signatures(big[:5000], np.array([0]), 64), minhash.signatures(big[5000:], np.array([0]), 64))
    assert (one == two).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 101), (300, 300)] + [(1000, i) for i in range(1001, 1080)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and got[200] == got[101] == 100 and got[1050] == 1000 and 300 not in got
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def removed_words(rows, width):
    first = {}
    words = {i: WORD.findall(t or "") for i, t in rows}
    for i in sorted(words):
        for p in range(len(words[i]) - width + 1):
            first.setdefault(tuple(words[i][p:p + width]), i)
    gone = {i: {j for p in range(len(w) - width + 1) if first[tuple(w[p:p + width])] < i for j in range(p, p + width)} for i, w in words.items()}
    return words, gone


@pytest.mark.parametrize("width,gram", [(50, 10), (12, 4)])
def test_repeated_passages(spark, docs, rows, width, gram):
    words, gone = removed_words(rows, width)
    got = substring.remove_repeats(docs, width=width, gram=gram, shard_windows=40, shard_documents=3).collect()
    assert len(got) == len(rows) and sum(map(len, gone.values())) > 0
    for r in got:
        w, g = words[r.doc_id], gone[r.doc_id]
        assert (r.n_words, r.n_removed) == (len(w), len(g)), r.doc_id
        assert r.words_sha256 == hashlib.sha256(" ".join(w).encode()).hexdigest()
        if 0 < len(g) < len(w):
            assert r.kept_text == " ".join(x for j, x in enumerate(w) if j not in g)
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_repeated_passages_odd_ids(spark):
    t = " ".join(f"a{i}" for i in range(60))
    df = spark.createDataFrame([(None, t), (4, t), (4, t), (7, t + " end"), (7, "short")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substring.remove_repeats(df).collect()), key=str)
    assert got == sorted([(None, 60, 0), (4, 60, 0), (4, 60, 0), (7, 61, 60), (7, 1, 0)], key=str)


def test_pack_texts(spark, docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    odd = [(900, "It's  12<|endoftext|>\tx\u00a0y\x1cz e\u0301\n\nİ ΣΑΣ"), (901, ""), (902, "a<|startoftext|>b <|startoftext|> <|endoftext|><|startoftext|> <|start c")]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    got = packing.pack_texts(df, path, tokens=64, segments=3, loss=60).collect()
    ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for i, t in [*rows, *odd]}
    seqs = {}
    for r in got:
        assert zlib.crc32(ids[r.doc_id][4 * r.start:4 * (r.start + r.length)]) == r.ids_crc32 and r.doc_tokens * 4 == len(ids[r.doc_id])
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, b in ids.items():
        at = 0
        for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at * 4 == len(b)
    for s in seqs.values():
        s.sort()
        assert len(s) <= 3 and sum(n for _, n in s) <= 60 and [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))]
    assert packing.pack_texts(df.limit(0), path).count() == 0


def test_pack_ids_with_loss_flags(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randrange(9) for _ in range(n)], [rng.random() < 0.5 for _ in range(n)]) for i, n in enumerate([0, 1, 5, 40, 200, 33, 64, 7] * 20)]
    df = spark.createDataFrame(rows + [(999, None, None)], "id long, ids array<long>, flags array<boolean>").coalesce(2)
    got = packing.pack_ids(df, "id", "ids", "flags", tokens=64, segments=4, loss=20, open_bins=8).collect()
    seqs = {}
    for r in got:
        assert r.n_loss == sum(rows[r.id][2][r.start:r.start + r.length])
        seqs.setdefault(r.sequence_id, []).append(r)
    assert all(sum(x.length for x in s) <= 64 and len(s) <= 4 and sum(x.n_loss for x in s) <= 20 for s in seqs.values())
    assert {i: sum(r.length for r in got if r.id == i) for i, x, _ in rows if x} == {i: len(x) for i, x, _ in rows if x}


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(4)
    m = toxicity.Model({f"t{i}": i for i in range(60)}, rng.random(60) + 1)
    examples = [(i, int(rng.integers(2)), 1.0, {int(t): int(rng.integers(1, 4)) for t in rng.choice(60, rng.integers(0, 9), False)}) for i in range(700)]
    m.build(examples)
    counts = {i: c for i, _, _, c in examples}
    dense = np.zeros((len(m.ids), 60))
    for k, i in enumerate(m.ids):
        t, w = m.vector(counts[i])
        dense[k, t] = w
    for _ in range(60):
        t, w = m.vector({int(x): 1 for x in rng.choice(60, 5, False)})
        pos, cos = m.nearest(t, w)
        full = dense[:, t] @ w
        assert cos == pytest.approx(np.sort(full)[::-1][:15]) and full[pos] == pytest.approx(cos)


def test_toxicity_held_out(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).join(labels, "doc_id").select("doc_id", "score", "predicted", "toxic", toxicity.held_out().alias("h")).collect()
    out = [r for r in got if r.h]
    assert {r.doc_id for r in out} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    pos, neg = [r.score for r in out if r.toxic], [r.score for r in out if not r.toxic]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.9 and np.mean([r.predicted for r in out if not r.toxic]) < 0.02
    edge = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (2, "", 1.0), (None, "word " * 9000, 0.0)], "doc_id long, text string, score double")
    e = toxicity.score(edge, model).collect()
    assert len(e) == 4 and len({r.score for r in e if r.doc_id}) == 1 and all(0 <= r.score <= 1 for r in e)
    assert toxicity.score(edge.limit(0), model).count() == 0
    empty = toxicity.fit(docs.limit(0), labels)
    assert {r.score for r in toxicity.score(edge, empty).collect()} == {0.0}
    assert {r.score for r in toxicity.score(edge, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}


def test_toxicity_learns_rare_terms(spark):
    """Terms that only toxic rows have count however rare they are, whatever the bound on the others."""
    rng = random.Random(5)
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1][:66]
    prose = lambda: " ".join(rng.choice([f"common{k}" for k in range(40)]) for _ in range(30))
    rows = [(i, prose() + ("" if k >= 6 else f" {'loser' if k % 2 else 'scum'}")) for k, i in enumerate(ids)]
    labels = spark.createDataFrame([(i, int(k < 6)) for k, i in enumerate(ids)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for max_terms in (toxicity.MAX_TERMS, 0):
        model = toxicity.fit(docs, labels, max_terms=max_terms)
        assert {"loser", "scum"} <= set(model.vocabulary) and "common1" not in model.vocabulary
        got = toxicity.score(spark.createDataFrame([(1, "common1 loser"), (2, "common1 day")], "doc_id long, text string"), model).collect()
        score = {r.doc_id: r.score for r in got}
        assert score[1] > score[2] and [e.label for r in got if r.doc_id == 1 for e in r.evidence] == [1, 1, 1]


def test_rollup_deltas(spark, tmp_path):
    schema = "doc_id long, source string, lang string, version string, tokens long, extra string"
    one = spark.createDataFrame([(1, "a", "en", "v1", 10, ""), (2, "a", "en", "v1", 5, ""), (3, None, "en", "v1", 7, ""), (4, "b", "de", "v1", None, "")], schema)
    two = spark.createDataFrame([(1, "a", "en", "v1", 12, ""), (3, None, "en", "v1", 7, ""), (4, "b", "de", "v1", None, ""), (1, "a", "en", "v2", 3, "")], schema)
    store = rollups.Rollup(spark, str(tmp_path / "store"))
    store.commit(1, rollups.deltas(None, one))
    for _ in range(3):
        store.commit(2, rollups.deltas(one, two))
    store.commit(3, rollups.deltas(two, two))  # nothing changed
    got = {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in store.totals().collect()}
    assert got == {("a", "en", "v1"): (1, 12), (None, "en", "v1"): (1, 7), ("b", "de", "v1"): (1, 0), ("a", "en", "v2"): (1, 3)}
    store.commit(4, rollups.deltas(two, None))
    assert all((r.n_docs, r.n_tokens) == (0, 0) for r in store.totals().collect())
    store.commit(4, rollups.deltas(two, two))  # the same batch again, now without changes: it is cleared
    got = {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in store.totals().collect()}
    assert got == {("a", "en", "v1"): (1, 12), (None, "en", "v1"): (1, 7), ("b", "de", "v1"): (1, 0), ("a", "en", "v2"): (1, 3)}
    empty = rollups.Rollup(spark, str(tmp_path / "empty"))
    empty.commit(1, rollups.deltas(None, one.limit(0)))
    assert empty.totals().count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_placement_has_the_greatest_dot_product(seed):
    """While a fitting sequence is open, an example goes whole to the one whose room has the
    greatest dot product with its demand; loss and segment limits bind too."""
    rng = np.random.default_rng(seed)
    limits = (50, 6, 20)
    p = packing.Packer(*limits, open_bins=5)
    for i in range(60):
        n = int(rng.integers(1, 45))
        flags = rng.random(n) < 0.3
        demand = np.array([n, 1, int(flags.sum())], float)
        before = [(k, p.room[k].copy()) for k in np.flatnonzero(p.live)]
        fits = [(float((r / limits) @ (demand / limits)), -k) for k, r in before if (r >= demand).all()]
        held = {k: len(p.bins[k]) for k, _ in before}
        closed = len(p.closed)
        p.add(i, np.arange(n, dtype="<u4").tobytes(), flags)
        if fits:
            k = -max(fits)[1]
            went = p.bins[k][-1] if p.live[k] and len(p.bins[k]) == held[k] + 1 else p.closed[closed][-1]
            assert went[0] == i and len(went[2]) == 4 * n
    p.finish()
    placed = {}
    for seq in p.closed:
        assert sum(len(x[2]) // 4 for x in seq) <= 50 and len(seq) <= 6 and sum(int(x[3].sum()) for x in seq) <= 20
        for i, start, ids, _ in seq:
            placed.setdefault(i, []).extend(range(start, start + len(ids) // 4))
    assert sorted(placed) == list(range(60)) and all(sorted(v) == list(range(len(v))) for v in placed.values())


def test_most_sequences_are_closed_by_placement():
    """What is open at the end is topped up from the least filled, not laid out anew."""
    rng = np.random.default_rng(1)
    p = packing.Packer(4096, 256, 4096)
    for i in range(600):
        p.add(i, np.zeros(int(rng.integers(50, 1500)), "<u4").tobytes())
    whole = {k for k in range(64) if p.live[k]}
    kept = {k: list(p.bins[k]) for k in whole}
    before = len(p.closed)
    p.finish()
    begins = [seq[0][:2] for seq in p.closed[before:]]
    assert sum(b[0][:2] in begins for b in kept.values() if b) > 0.6 * len(kept)
    sizes = [sum(len(x[2]) // 4 for x in seq) for seq in p.closed]
    assert all(n == 4096 or n & (n - 1) == 0 for n in sizes)


def test_packing_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "y"), (None, "c", "z"), (None, None, "w")], "doc_id long, text string, sequence_id string")
    rows = packing.pack_texts(df, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted((str(r.doc_id), r.doc_tokens) for r in rows if r.start == 0) == sorted([("1", 3), ("1", 3), ("None", 2), ("None", 1)])


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "near duplicates", "repeated passages", "packing"]
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    cur, seen = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in cur.collect()}
        cur = stage(spark, cur, SF01).cache()
        assert cur.columns == docs.columns and {r.doc_id for r in cur.collect()} <= set(before)
        seen.append(cur.count())
    assert seen[-1] > 0.5 * seen[0] and seen[1] < seen[0]
    after = {r.doc_id: r.text for r in cur.collect()}
    sets = {i: shingles(before[i], 5) for i in before}  # input of the last text stage: no near copies left
    assert not [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    words, gone = removed_words(sorted(before.items()), 50)
    for i, t in after.items():
        assert t == (before[i] if not gone[i] else " ".join(w for j, w in enumerate(words[i]) if j not in gone[i]))
    packed = corpus_pipeline.run(spark, SF01).collect()
    assert {r.doc_id for r in packed} == set(after)
    assert all(sum(r.length for r in packed if r.doc_id == i) == next(r.doc_tokens for r in packed if r.doc_id == i) for i in list(after)[:20])
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF01).count() == 0


def test_pipeline_stages_on_odd_ids(spark):
    long = " ".join(f"a{i}" for i in range(80))
    rows = [(1, long), (2, "the start of " + long + " and the end"), (2, "the other text of id two"), (2, "the start of " + long + " and the end"),
            (None, "the text without an id"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.substring_stage(spark, docs, "").collect()), key=str)
    want = [(1, long), *[(2, "the start of and the end")] * 2, (2, "the other text of id two"), (None, "the text without an id"), (None, None)]
    assert got == sorted(want, key=str)
    kept = corpus_pipeline.near_dedup_stage(spark, docs, "").collect()
    assert {r.doc_id for r in kept} == {1, None}  # id 2 is one document, a near copy of 1
    assert corpus_pipeline.quality_stage(spark, docs, "").columns == docs.columns
