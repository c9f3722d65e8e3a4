"""Row-wise operators against brute force: quality rules, piece encoding, fingerprints, licences, URLs."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash

from zonecast.llm import licenses, piece_bpe, quality, url_filter, winnowing

SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 700}" for i in range(6000))
TEXTS = [None, "", " \n\t", "one", "a b", "the cat sat on the mat and the dog sat on the log", "x " * 40, LONG, LONG,
         "Ähre ☃ naïve\u00a0gap 中文字 ﬁ", "l1 a b c d e\nl1 a b c d e\n\nl2 ## $$ f\x0bg", "a#b|c<d>&%$*", "12 34 the 5!"]


@pytest.fixture(scope="module")
def docs(spark):
    """Texts with null ids, repeated rows and columns that clash with results."""
    rows = [(i, t, "own", "own2") for i, t in enumerate(TEXTS)] + [(None, "null id text", "own", None), (3, "one", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, ids string")


def metrics_of(t):
    t = t or ""
    w = WORD.findall(t)
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = {}
    for g in win:
        seen[g] = seen.get(g, 0) + 1
    covered = {j for i, g in enumerate(win) if seen[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in t), len(lines) - len(set(lines)), len(covered))


def test_quality_metrics(spark, docs):
    got = quality.judge(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == metrics_of(r.text), r.text
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert isinstance(r.kept, bool) and r.ids in ("own2", None) and not (r.base_failed and r.kept)
    assert quality.judge(docs.limit(0)).count() == 0


def test_piece_encoder_equals_library(spark, docs):
    model = public_tokenizers.path("piece_bpe_32k.model")
    e = piece_bpe.PrefixTableEncoder(model)
    rng = random.Random(5)
    pieces = list(e.ids)
    samples = [t for t in TEXTS if t] + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))) for _ in range(1500)]
    samples += ["".join(rng.choice("ab  \n\t▁é中\x00<s>x") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    for s in samples:
        assert np.frombuffer(e.encode(s), "<u4").tolist() == e.sp.encode(s, add_bos=True, add_eos=True), s
    got = piece_bpe.round_trip(docs, model).collect()
    assert len(got) == docs.count() and {r.kept for r in got} <= {"own", None}
    for r in got:
        ids = e.sp.encode(r.text or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(e.sp.decode(ids).encode()).hexdigest()
    both = piece_bpe.decode(piece_bpe.encode(docs.select("doc_id", "text"), model), model).collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in both)
    assert piece_bpe.round_trip(docs.limit(0), model).count() == 0


def chain(parts):
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), seed=h)
    return h - (1 << 64) if h >> 63 else h


def winnowed(t, k, w, char_k, char_w, char_below):
    t = t or ""
    short = len(t) < char_below
    u = list(t) if short else WORD.findall(t)
    k, w = (char_k, char_w) if short else (k, w)
    if not u:
        return []
    g = [chain(u)] if len(u) < k else [chain(u[i:i + k]) for i in range(len(u) - k + 1)]
    out, low = [], (1 << 28) - 1
    for i in range(max(1, len(g) - w + 1)):
        best = min(range(i, min(i + w, len(g))), key=lambda j: (g[j] & ~low, -j))  # least, rightmost
        if best not in out[-1:]:
            out.append(best)
    return [(g[p], p) for p in out]


@pytest.mark.parametrize("k,w,char_k,char_w,char_below", [(3, 12, 5, 4, 512), (2, 5, 3, 7, 20), (1, 1, 1, 1, 0)])
def test_winnowing(spark, docs, k, w, char_k, char_w, char_below):
    got = winnowing.fingerprint(docs, "text", "kept", k, w, char_k, char_w, char_below).collect()
    for r in got:
        assert [(x.hash, x.position) for x in r.kept] == winnowed(r.text, k, w, char_k, char_w, char_below), r.text
    assert winnowing.fingerprint(docs.limit(0)).count() == 0


def test_winnowing_guarantee_and_next(spark):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(500)]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(6)]
    shared = " ".join(f"s{i}" for i in range(14))  # k + w - 1 words
    texts[4] = texts[4][:600] + " " + shared + " " + texts[4][600:]
    texts[5] = shared + " " + texts[5]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    fps = {r.doc_id: {x.hash for x in r.fingerprint} for r in winnowing.fingerprint(df).collect()}
    assert fps[4] & fps[5] and not fps[0] & fps[1]
    out = {r.doc_id: r for r in winnowing.edited_likeness(df).collect()}
    for i, t in enumerate(texts):
        n, q = len(t), len(t) // 4
        edited = t[:n - q] + texts[(i + 1) % 6][:q]
        assert out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and out[i].n_chars == n
        a, b = ({h for h, _ in winnowed(x, 3, 12, 5, 4, 512)} for x in (t, edited))
        assert out[i].near_edited == pytest.approx(len(a & b) / len(a | b))
    assert winnowing.edited_likeness(df.limit(0)).count() == 0


def test_likeness_on_both_sides_of_the_short_length(spark):
    text = " ".join(f"word{i:03d}" for i in range(66))  # 527 characters
    han = "".join(chr(0x4E00 + 7 * i) for i in range(600))
    rows = [(1, text + " ending of it"), (2, text[:500]), (3, "x"), (4, han), (5, "一 " + han[:440])]
    assert [len(t) < 512 for _, t in rows] == [False, True, True, False, True]
    out = {r.doc_id: r for r in winnowing.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    prints = {i: set(r.fingerprint.split()) for i, r in out.items()}
    assert prints[1] & prints[2] and out[1].near_next > 0.5  # long, then short
    assert prints[4] & prints[5] and out[4].near_next > 0.5  # without blanks
    short_edit = spark.createDataFrame([(1, text + " ending of it"), (2, "x")], "doc_id long, text string")
    first = winnowing.edited_likeness(short_edit).where("doc_id = 1").first()
    assert first.n_chars >= 512 and first.near_edited > 0.5  # three quarters unchanged, the edited text under 512


def told_by(a: str, b: str) -> float:
    """The likeness of two published fingerprints: by characters too if both have them."""
    (aw, _, ac), (bw, _, bc) = (x.partition("|") for x in (a, b))
    x, y = set(aw.split()), set(bw.split())
    if ac and bc:
        x, y = x | set(ac.split()), y | set(bc.split())
    return len(x & y) / len(x | y) if x | y else 1.0


def test_likenesses_follow_from_the_published_fingerprints(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10 ** 6 + i, t) for i, t in enumerate(["", None, "x", "a b", "w " * 255 + "ab", "w " * 255 + "abc"])], "doc_id long, text string"))
    got = sorted(winnowing.edited_likeness(rows).collect(), key=lambda r: r.doc_id)
    for r, after in zip(got, [*got[1:], got[0]]):
        assert r.near_edited == pytest.approx(told_by(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(told_by(r.fingerprint, after.fingerprint))


def test_edited_likeness_edges(spark, docs):
    got = winnowing.edited_likeness(docs).collect()
    assert len(got) == docs.count()
    same = [r.fingerprint for r in got if r.doc_id in (7, 8)]
    assert same[0] == same[1] and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_license_scan(spark):
    mit = licenses.KNOWN["MIT"]
    rows = [(0, "Copyright (c) 2020 A. Person\n" + mit.upper().replace(",", " ;")), (1, mit + " extra"), (2, None), (3, ""), (4, "..."),
            (5, "text\nReleased under the MIT Licence!\nmore"), (5, "Licensed under CC BY-NC 4.0."), (6, mit.replace(" ", "\n\t"))]
    known = spark.createDataFrame(list(licenses.KNOWN.items()), "license string, text string")
    df = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, license string")
    got = sorted(((r.doc_id, r.license, r.line_licenses) for r in licenses.scan(df, known).collect()), key=str)
    assert got == sorted([(0, "MIT", None), (1, None, None), (2, None, None), (3, None, None), (4, None, None),
                          (5, None, "CC-BY-NC-4.0 notice, MIT notice"), (5, "CC-BY-NC-4.0 notice", "CC-BY-NC-4.0 notice, MIT notice"),
                          (6, "MIT", None)], key=str)
    assert licenses.scan(df.limit(0), known).count() == 0
    assert licenses.scan(df, known.limit(0)).where("license IS NOT NULL").count() == 0


def test_license_spellings_and_copyright_lines(spark):
    gpl = "This work is licensed under the "
    rows = [(1, gpl + "GNU GPL v3.0"), (2, gpl + "GNU General Public Licence, version 3"), (3, gpl + "gnu gpl v3"), (4, gpl + "GNU GPL v2.0"),
            (None, "Licensed under CC BY 4.0."), (None, None), (6, "(c) any list item\nReleased under the MIT License."),
            (7, "(c) 2020 A. Person\nReleased under the MIT License."), (8, "© A. Person\nReleased under the MIT License."),
            (9, "y " * 40_000 + "\nReleased under the MIT License.")]
    known = spark.createDataFrame([*licenses.KNOWN.items(), ("three", "licence licence licence")], "license string, text string")
    got = {(r.doc_id, r.license, r.line_licenses) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()}
    notice, mit = "GPL-3.0 notice", "MIT notice"
    assert got == {(1, notice, notice), (2, notice, notice), (3, notice, notice), (4, None, None), (None, "CC-BY-4.0 notice", "CC-BY-4.0 notice"),
                   (None, None, "CC-BY-4.0 notice"), (6, None, mit), (7, mit, mit), (8, mit, mit), (9, None, mit)}
    three = spark.createDataFrame([(1, "license license license")], "doc_id long, text string")
    assert licenses.scan(three, known).first().license == "three"


def test_a_large_known_list_is_joined_with_equal_results(spark, monkeypatch):
    known = spark.createDataFrame(list(licenses.KNOWN.items()), "license string, text string")
    df = spark.createDataFrame([(1, licenses.KNOWN["MIT"]), (2, "x\nReleased under the MIT License."), (3, None)], "doc_id long, text string")
    small = sorted(map(tuple, licenses.scan(df, known).collect()))
    monkeypatch.setattr(licenses, "MAX_BROADCAST_ROWS", 0)
    assert sorted(map(tuple, licenses.scan(df, known).collect())) == small


URLS = [None, "", "no scheme", "http://", "HTTP://Shop.Example.COM/de/x?y#z", "x://example.net/en/", "x://a.b.example.net/en", "x://net", "x://net/",
        "x://sub.net/q", "x://notexample.com/de/", "x://example.com/de", "x://org/fr/", "x://a.org/fr/1#f", "x://evil.test/p?x", "x://deep.evil.test",
        "x://évil.test/p", "x://a.org?x=/fr/", "x://example.com/DE/"]
ENTRIES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("evil.test", "block"),
           ("evil.test", "allow"), (None, "block"), ("évil.test/", "allow")]


def brute_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for e, _ in ENTRIES:
        if e is not None:
            h, slash, p = e.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith(slash + p) and (best is None or len(e) > len(best)):
                best = e
    verdict = "allow" if best is None else "block" if (best, "block") in ENTRIES else "allow"
    return host, path, best, verdict


@pytest.mark.parametrize("limit", [url_filter.MAX_LIST_BYTES, 0])
def test_url_rules(spark, limit):
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(URLS + URLS[:5])], "page_id long, url string, rule string")
    entries = spark.createDataFrame(ENTRIES, "entry string, verdict string")
    got = url_filter.judge(pages, entries, max_list_bytes=limit).collect()
    assert len(got) == len(URLS) + 5
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute_rule(r.url), r.url
    assert url_filter.judge(pages.limit(0), entries, max_list_bytes=limit).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, entries.limit(0)).collect()} == {"allow"}


def test_digest_array_collision(monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda b: len(b) % 2)  # many strings per digest
    a = url_filter.DigestArray(url_filter.DigestArray.build([(f"host{i}", "block") for i in range(30)]))
    assert (a.find([f"host{i}" for i in range(30)]) >= 0).all() and (a.find(["host99", "", "hosta"]) == -1).all()


def test_rules_for_latin_words_spare_other_scripts(spark):
    russian = " ".join("каждый охотник желает знать где сидит фазан если погода хорошая".split()[i % 10] + "аб"[i % 2] * (i % 7) for i in range(60))
    chinese = " ".join("春眠不觉晓处处闻啼鸟夜来风雨声花落知多少"[i % 15:i % 15 + 5] + str(i) for i in range(60))
    polish = " ".join(f"zażółć{i} gęślą{i} jaźń{i}" for i in range(30))
    rows = [(1, russian, "ru"), (2, chinese, "zh"), (3, polish, "pl"), (4, polish, "de"), (5, polish, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id: r.kept for r in quality.judge(df, lang="lang").collect()} == {1: True, 2: True, 3: True, 4: False, 5: False}
    assert {r.doc_id: r.kept for r in quality.judge(df).collect()} == {1: True, 2: True, 3: False, 4: False, 5: False}
