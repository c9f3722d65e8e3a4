"""Best-fit packing, part codes and tokenizer alignment against brute force."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zonecast.llm import alignment, best_fit, part_codes
from zonecast.llm.byte_ids import ByteIds, byte_signs

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = " \n\t\r\x0b\x1c\x85\xa0　᠎ ab'sZ9éêñ漢!?.,▁😀<|endoftext|></s>\0"


def random_texts(n, seed=1, length=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, length))) for _ in range(n)]


TEXTS = [None, "", " ", "  ", "\n", "\n\n  x", "it's  \n y ", "foo ", "a<|endoftext|>b", "▁ mark", "don't, won't!",
         "Äpfel schäch, niño... 2024, a-b", "same text here", "same text here", "word " * 3000, "x" * 5000, "one\ntwo\tthree  four"]


# -- best-fit packing ----------------------------------------------------------------

@pytest.mark.parametrize("as_text", [False, True])
def test_byte_ids_equal_the_library(as_text):
    tok = Tokenizer.from_file(BYTE)
    tok.encode_special_tokens = as_text
    texts = [t or "" for t in TEXTS] + random_texts(3000)
    got = ByteIds(BYTE, special_as_text=as_text).of(texts)
    assert all(np.frombuffer(g, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids for t, g in zip(texts, got))


def test_word_ids_equal_the_library():
    from zonecast.llm.packing import WordIds
    file = public_tokenizers.path("word_bpe_49k.json")
    tok, words = Tokenizer.from_file(file), WordIds(file)
    assert words.simple
    signs = SIGNS.replace("<|endoftext|>", "<|endoftext|><|startoftext|>") + "ÀßÿÇŒǅÅABC|*"
    rng = random.Random(4)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["HELLO World!!", "Straße, ÉCOLE... naïve?", "İstanbul ı", "a--b c", "x|y|z ***"]
    for t, got in zip(texts, words.of(texts)):
        assert np.frombuffer(got, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def naive_best_fit(lengths, cap):
    room = []
    for need in sorted(lengths, reverse=True):
        fits = [(r, k) for k, r in enumerate(room) if r >= need]
        if fits:
            room[min(fits)[1]] -= need
        else:
            room.append(cap - need)
    return sorted(room)


@pytest.mark.parametrize("seed", range(40))
def test_placement_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    cap = rng.choice([1, 7, 20, 64])
    lengths = [rng.randint(1, cap) for _ in range(rng.randint(0, 80))]
    where, offset, n = best_fit.best_fit_decreasing(lengths, cap)
    used = np.zeros(n, int)
    for k in np.argsort(offset, kind="stable"):
        assert offset[k] == used[where[k]]
        used[where[k]] += lengths[k]
    assert sorted((cap - used).tolist()) == naive_best_fit(lengths, cap)


def test_lengths_beyond_the_capacity_are_refused():
    with pytest.raises(ValueError):
        best_fit.best_fit_decreasing([3, 9], 8)


def check_packing(rows, texts, cap):
    tok = Tokenizer.from_file(BYTE)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for i, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        at = 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            part = ids[at:at + r["length"]]
            assert len(part) == r["length"] and r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            assert r["length"] == cap or k == 0
            at += r["length"]
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= cap
    return len(by_seq)


def test_packing_covers_every_id_once(spark):
    texts = list(enumerate(TEXTS + random_texts(300, 5)))
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in texts], "doc_id long, text string, sequence_id string, `offset` int")
    rows = best_fit.pack_best_fit(df.repartition(5), BYTE, tokens=64).collect()
    n = check_packing([r.asDict() for r in rows], texts, 64)
    lengths = [r.length for r in rows]
    assert n == len(naive_best_fit(lengths, 64))               # one group: the plain algorithm's number
    grouped = best_fit.pack_best_fit(df, BYTE, tokens=64, rows_per_group=50).collect()
    m = check_packing([r.asDict() for r in grouped], texts, 64)
    assert n <= m <= n + -(-len(rows) // 50)
    assert best_fit.pack_best_fit(df.limit(0), BYTE).count() == 0


def test_packing_keeps_repeated_and_null_ids_and_gives_the_ids(spark):
    df = spark.createDataFrame([(1, "some text"), (1, "some text"), (None, "other"), (None, None)], "doc_id long, text string")
    rows = best_fit.pack_best_fit(df, BYTE, with_ids=True).collect()
    assert Counter(r.doc_id for r in rows) == {1: 2, None: 2}
    tok = Tokenizer.from_file(BYTE)
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in rows) == sorted(
        tok.encode(t, add_special_tokens=False).ids + [2] for t in ("some text", "some text", "other", ""))


# -- part codes ----------------------------------------------------------------------

def lloyd(x, parts, entries, rounds):
    x = x.reshape(len(x), parts, -1)
    books, codes, error = [], [], np.zeros(len(x), np.int64)
    for p in range(parts):
        b = x[:entries, p].copy()
        for _ in range(rounds):
            e = ((x[:, p, None] - b[None]) ** 2).sum(2).argmin(1)
            for k in range(len(b)):
                if (e == k).any():
                    b[k] = x[e == k, p].sum(0) // (e == k).sum()
        d = ((x[:, p, None] - b[None]) ** 2).sum(2)
        codes.append(d.argmin(1))
        error += d.min(1)
        books.append(b)
    return books, np.array(codes).T, error


@pytest.mark.parametrize("kind", ["spread", "ties", "copies"])
def test_codes_equal_plain_rounds(spark, kind):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(700, 16)).astype("f4") / 4
    if kind == "ties":
        v = rng.integers(-2, 3, (700, 16)).astype("f4") / 4096
    if kind == "copies":
        v[200:600] = v[3]
    rows = [(int(i), x.tolist(), int(i % 3) if i % 5 else None, "e") for i, x in enumerate(v)]
    bad = [(900, None, 1, ""), (901, [0.0] * 15 + [float("nan")], 1, ""), (902, [0.0] * 15 + [float("inf")], 1, ""),
           (903, [0.0] * 15 + [None], 1, ""), (904, [], 1, "")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int, error string").repartition(6)
    out, books = part_codes.encode(df, parts=4, entries=8, rounds=5, block_rows=150)
    want_books, codes, error = lloyd(np.floor(v.astype(float) * 4096).astype(np.int64), 4, 8, 5)
    assert all((a == b).all() for a, b in zip(books, want_books))
    got = {r.vec_id: r for r in out.collect()}
    assert sorted(got) == list(range(700))
    by_label = defaultdict(int)
    for i, r in got.items():
        assert r.code == "".join(f"{c:02x}" for c in codes[i]) and r.error == error[i]
        by_label[r.label] += r.error
    assert all(r.label_error == by_label[r.label] for r in got.values())
    flat = ",".join(str(x) for b in want_books for x in b.ravel())
    assert part_codes.books_sha256(books) == hashlib.sha256(flat.encode()).hexdigest()


def test_balls_hold_their_points_and_are_owned():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(-20, 20, (600, 4)) + c for c in ([0] * 4, [900] * 4, [-900] * 4)]).astype(np.int64)
    tree = part_codes.BallTree(x)
    y = x[tree.order]
    for k in range(len(tree.lo)):
        own = y[tree.lo[k]:tree.hi[k]]
        assert (tree.sums[k] == own.sum(0)).all()
        assert np.sqrt(((own - tree.center[k]) ** 2).sum(1)).max() <= tree.radius[k] + 1e-9
    book = np.array([[0] * 4, [900] * 4, [-900] * 4, [5000] * 4], np.int64)
    count, total, owned = part_codes.part_sums(tree, y, book)
    assert owned == 1800 and count.tolist() == [600, 600, 600, 0] and (total.sum(0) == x.sum(0)).all()


def test_codes_of_few_or_odd_vectors(spark):
    kind = "vec_id long, embedding array<double>, label int"
    empty, _ = part_codes.encode(spark.createDataFrame([], kind))
    assert empty.count() == 0 and empty.columns == ["vec_id", "code", "error", "label", "label_error"]
    few = spark.createDataFrame([(1, [1.0, 2.0], None), (1, [1.0, 2.0], None), (None, [5.0, 2.0], 3)], kind)
    out, books = part_codes.encode(few, parts=2)
    assert [len(b) for b in books] == [2, 2] and out.count() == 3
    assert part_codes.encode(spark.createDataFrame([(None, [1.0, 2.0], 1)], kind), parts=2)[0].count() == 0
    with pytest.raises(Exception, match="equal and divisible"):
        part_codes.encode(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], kind), parts=2)


# -- alignment -----------------------------------------------------------------------

def brute_alignment(texts):
    tok = Tokenizer.from_file(BYTE)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    back = {c: b for b, c in byte_signs().items()}
    vocab = {i: bytes(back[c] for c in t) for t, i in tok.get_vocab().items() if all(c in back for c in t)}

    def of_b(i):
        return bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()

    docs, count = [], Counter()
    for t in texts:
        a = tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        pa, pb = [vocab[i] for i in a], [of_b(i) for i in b]
        if not t or b"".join(pa) != (" " + t).encode() or b"".join(pb) != (" " + t).encode():
            docs.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in pa]).tolist(), np.cumsum([len(x) for x in pb]).tolist()
        both = sorted(set(ends_a) & set(ends_b))
        links = [(a[ends_a.index(e)], b[ends_b.index(e)]) for e in both]
        groups, i, j = [], 0, 0
        for e in both:
            i2, j2 = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        count.update(links)
        docs.append((len(a), len(b), links, ";".join(groups)))
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            na, nb, links, groups = d
            out.append((na, nb, len(links), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
                        hashlib.sha256(groups.encode()).hexdigest()))
    return out, count


def test_alignment_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_DOCS", 37)           # several blocks per task
    texts = TEXTS + random_texts(250, 9) + ["the cat sat on the mat, " * k for k in range(1, 30)]
    want, count = brute_alignment(texts)
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)],
                               "doc_id long, text string, block string, n_a int").repartition(4)
    got = {r.doc_id: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
           for r in alignment.align(df, BYTE, PIECE).collect()}
    assert [got[i] for i in range(len(texts))] == want
    pairs = {(r.a, r.b): r.n_links for r in alignment.pair_counts(alignment.index(df, BYTE, PIECE)).collect()}
    assert pairs == dict(count)


def test_alignment_of_odd_tables(spark):
    kind = "doc_id long, text string"
    assert alignment.align(spark.createDataFrame([], kind), BYTE, PIECE).count() == 0
    rows = alignment.align(spark.createDataFrame([(None, None), (None, ""), (3, "▁")], kind), BYTE, PIECE).collect()
    assert len(rows) == 3 and all(r.n_links == 0 and r.groups_sha256 == "" for r in rows)
    twice = alignment.align(spark.createDataFrame([(1, "a b"), (1, "a b")], kind), BYTE, PIECE).collect()
    assert len(twice) == 2 and twice[0] == twice[1]


@pytest.mark.parametrize("n", [1, 9, 70, 600])
def test_planes_give_the_counts_back(n):
    rng = random.Random(n)
    for _ in range(60):
        docs = np.array(sorted(rng.sample(range(n), rng.randint(1, n))))
        counts = np.array([rng.choice([1, 1, 2, 5, 300]) for _ in docs])
        back = np.zeros(n, int)
        for k, d in alignment.planes(alignment.pack_planes(docs, counts, n), n):
            back[d] += 1 << k
        assert (back[docs] == counts).all() and back.sum() == counts.sum()


def test_scores_add_up_over_the_corpus(spark):
    """Every link adds its pair's count: the sum over documents is the sum of squares of the counts."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    table = alignment.index(df, BYTE, PIECE)
    squares = sum(r.n_links ** 2 for r in alignment.pair_counts(table).select("n_links").collect())
    total = alignment.align(df, BYTE, PIECE).agg({"count_sum": "sum"}).first()[0]
    assert total == squares


# -- edges of earlier operators ---------------------------------------------------------

def test_long_texts_of_the_deduplication_operators(spark):
    """Texts of thousands of words: near copies are linked, shared passages go once."""
    from zonecast.llm import minhash, substring
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10 ** 6)}"
    base, passage = [word() for _ in range(4000)], [word() for _ in range(900)]
    near = list(base)
    for k in range(0, 4000, 100):
        near[k] = word()
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join([*(word() for _ in range(300)), *passage])),
            (4, " ".join([*passage, *(word() for _ in range(300))]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df, k=2).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring.remove_repeats(df.where("doc_id > 2"), width=50).collect()}
    assert got == {3: (1200, 0), 4: (1200, 900)}


def test_long_urls_and_long_counts(spark):
    from zonecast.llm import rollups, url_filter
    deep, path = ".".join(["a"] * 300), "/" + "p/" * 5000
    pages = spark.createDataFrame([(1, f"http://{deep}.evil.test{path}"), (2, f"http://evil.test.{deep}{path}")], "page_id long, url string")
    listed = spark.createDataFrame([("evil.test/p/", "block")], "entry string, verdict string")
    for limit in (1 << 20, 0):
        assert {r.page_id: r.verdict for r in url_filter.judge(pages, listed, max_list_bytes=limit).collect()} == {1: "block", 2: "allow"}
    text = spark.createDataFrame([("a, " * 200_000,)], "text string")
    assert text.select(rollups.word_count(F.col("text")), rollups.wordpunct_count(F.col("text"))).first()[:] == (200_000, 400_000)
