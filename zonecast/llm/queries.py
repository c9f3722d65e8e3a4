"""Registered queries of the ``llm`` operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.session import materialize, scratch_path

from . import alignment, best_fit, licenses, minhash, packing, part_codes, piece_bpe, quality, rollups, substring, toxicity, url_filter, winnowing
from .common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_STOPS = ", ".join(f"'{w}'" for w in quality.stop_forms())
_KNOWN = ", ".join(f"'{x}'" for x in quality.STOP_LANGUAGES)
_QUALITY_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(lower(left(lang, 2)) IN ({_KNOWN}), true) AS known_lang, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i AS p, array_to_string(w[i:i + 4], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
dup AS (SELECT doc_id, p FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, sum(least(5, nxt - p)) AS n FROM (
          SELECT doc_id, p, coalesce(lead(p) OVER (PARTITION BY doc_id ORDER BY p), p + 5) AS nxt FROM dup) GROUP BY doc_id),
m AS (SELECT d.doc_id, known_lang, length(regexp_replace(t, '[^\\pL]|\\p{{Latin}}', '', 'g')) AS n_foreign, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS ln,
        coalesce(rep.n, 0) AS n_repeat_words,
        len([x for x in w if x IN ({_STOPS})]) AS n_stop_words,
        len([x for x in w if NOT regexp_matches(x, '\\pL')]) AS n_no_letter
      FROM d LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, len(ln) AS n_lines, len(ln) - len(list_distinct(ln)) AS n_dup_lines FROM m),
j AS (SELECT *, {' OR '.join(f'({c})' for c in quality.BASE_RULES.values())} AS base_failed,
        {' OR '.join(f'({c})' + (' AND known_lang' if n == 'few_stop_words' else '') for n, c in quality.RULES.items())} AS more_failed FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT more_failed AS kept
FROM j"""


@query("op6_quality_rules", _QUALITY_SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), lang="lang").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def public_file(name: str) -> str:
    """Place of a public tokenizer file (the operators take it as a parameter)."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op9_piece_bpe")
def op9_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                public_file("piece_bpe_32k.model")).drop("text")


#: Rules of the contract (fixed values), and the list of junk sites (production parameter; the
#: operator takes lists of any size).
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
JUNK_SITES = [f"{name}.{zone}" for name in ("ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
              for zone in ("example.com", "example.net", "example.org")]
_JUNK = "|".join(s.replace(".", r"\.") for s in JUNK_SITES)
_URL_SQL = rf"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(host, '(^|\.)({_JUNK})$') THEN 'block' ELSE 'allow' END AS verdict FROM r"""


@query("op10_url_filters", _URL_SQL)
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's rules decide first; other URLs are blocked when their host or a parent
    of it is on the list of junk sites. Both lists go through the digest array."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "entry string, verdict string")
    junk = spark.createDataFrame([(site, "block") for site in JUNK_SITES], "entry string, verdict string")
    by_list = url_filter.judge(pages, junk).select(*pages.columns, F.col("verdict").alias("list_verdict"))
    judged = url_filter.judge(by_list, rules, default="")
    return judged.select("page_id", "host", "path", "rule",
                         F.when(F.col("verdict") != "", F.col("verdict")).otherwise(F.col("list_verdict")).alias("verdict"))


@query("op4_minhash_near_dedup")
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=2, threshold=80)


_SUBSTRING_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i AS p, md5(array_to_string(w[i:i + 49], ' ')) AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
own AS (SELECT g, min(doc_id) AS o FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM win JOIN own USING (g) WHERE doc_id > o),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n
         FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query("op5_substring_dedup", _SUBSTRING_SQL)
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = substring.remove_repeats(table(spark, sf_dir, "documents"), width=50)
    kept = F.when(F.col("n_removed") == 0, F.col("words_sha256")).otherwise(F.sha2(F.coalesce("kept_text", F.lit("")), 256))
    return r.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf_dir, "documents"), public_file("word_bpe_49k.json")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, evidence=False).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query("op1_winnowing")
def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_likeness(table(spark, sf_dir, "documents"))


_ROLLUP_SQL = r"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t,
             row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) AS k FROM documents),
c AS (SELECT source, lang, k,
        len(regexp_extract_all(array_to_string(list_distinct(string_split(t, chr(10))), ' '), '[^\x20\x09-\x0D]+')) AS a,
        len(regexp_extract_all(t, '[\pL\pN_]+|[^\x20\x09-\x0D\pL\pN_]')) AS b FROM d),
v AS (SELECT source, lang, 'words-1' AS version, k, a AS n FROM c UNION ALL SELECT source, lang, 'wordpunct-1', k, b FROM c)
SELECT source, lang, version, CAST(count(*) FILTER (WHERE k = 1) AS BIGINT) AS n_docs,
  CAST(coalesce(sum(n) FILTER (WHERE k = 1), 0) AS BIGINT) AS n_tokens FROM v GROUP BY source, lang, version"""


@query("op7_token_rollups", _ROLLUP_SQL)
def op7_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents go in (batch 1), get a second tokenizer version and counts revised to
    distinct lines (batch 2, committed twice), and exact copies go out (batch 3)."""
    t = F.coalesce("text", F.lit(""))
    docs = materialize(table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.sha2(t, 256).alias("key"), rollups.word_count(t).alias("n"),
        rollups.word_count(F.array_join(F.array_distinct(F.split(t, "\n")), " ")).alias("revised"),
        rollups.wordpunct_count(t).alias("punct")), "rollup-counts")
    state = lambda d, *pairs: d.select("doc_id", "source", "lang", F.explode(F.create_map(
        *[x for v, n in pairs for x in (F.lit(v), F.col(n))])).alias("version", "tokens"))
    first = state(docs, ("words-1", "n"))
    second = state(docs, ("words-1", "revised"), ("wordpunct-1", "punct"))
    kept = docs.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    copies = docs.join(kept, ["key", "doc_id"], "left_anti")
    store = rollups.Rollup(spark, scratch_path(spark, "token-rollups"))
    store.commit(1, rollups.deltas(None, first))
    for _ in range(2):  # the second commit is a retry and changes nothing
        store.commit(2, rollups.deltas(first, second))
    store.commit(3, rollups.deltas(state(copies, ("words-1", "revised"), ("wordpunct-1", "punct")), None))
    return store.totals()


def _canonical_sql(t: str) -> str:
    t = f"regexp_replace(lower(coalesce({t}, '')), '{licenses.COPYRIGHT_LINE}', '\\1', 'g')"
    t = f"' ' || regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || ' '"
    for a, b in licenses.EQUIVALENT:
        t = f"replace({t}, '{licenses.spaced(a)}', '{licenses.spaced(b)}')"
    return f"trim(replace({t}, '  ', ' '), ' ')"


def _text_sql(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_LICENSE_SQL = f"""
WITH k AS (SELECT sha256({_canonical_sql('text')}) AS digest, min(license) AS license
           FROM (VALUES {', '.join(f'({_text_sql(n)}, {_text_sql(t)})' for n, t in licenses.KNOWN.items())}) AS v(license, text) GROUP BY 1),
w AS (SELECT doc_id, sha256({_canonical_sql('text')}) AS digest FROM documents),
l AS (SELECT DISTINCT doc_id, license FROM (SELECT doc_id, sha256({_canonical_sql('line')}) AS digest
        FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)) JOIN k USING (digest)),
a AS (SELECT doc_id, string_agg(license, ', ' ORDER BY license) AS line_licenses FROM l GROUP BY doc_id)
SELECT doc_id, digest, license, line_licenses FROM w LEFT JOIN k USING (digest) LEFT JOIN a USING (doc_id)"""


@query("op8_license_scan", _LICENSE_SQL)
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.createDataFrame(list(licenses.KNOWN.items()), "license string, text string")
    return licenses.scan(table(spark, sf_dir, "documents"), known)


@query("op11_best_fit_packing")
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_best_fit(table(spark, sf_dir, "documents"), public_file("byte_bpe_50k.json"))


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain Lloyd rounds over all parts and entries."""
    near = """SELECT rid, part, min(d * 256 + entry) % 256 AS entry, min(d * 256 + entry) // 256 AS d FROM (
        SELECT p.rid, p.part, c.entry, CAST(list_sum(list_transform(list_zip(p.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM p JOIN c{r} c USING (part)) GROUP BY rid, part"""
    ctes = [f"""k AS (SELECT row_number() OVER () AS rid, vec_id, label,
        list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS v FROM embeddings
      WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))""",
            f"""p AS (SELECT rid, vec_id, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS q
      FROM k, range({parts}) t(part))""",
            f"""c0 AS (SELECT part, entry, q FROM (SELECT part, q, row_number() OVER (PARTITION BY part ORDER BY vec_id, q) - 1 AS entry
      FROM p WHERE vec_id IS NOT NULL) WHERE entry < {entries})"""]
    for r in range(rounds):
        ctes += [f"a{r} AS MATERIALIZED ({near.format(r=r)})",
                 f"""m{r} AS (SELECT part, entry, i, sum(q[i])::BIGINT AS s, count(*) AS n
      FROM (SELECT p.part, a.entry, p.q, unnest(range(1, len(p.q) + 1)) AS i FROM p JOIN a{r} a USING (rid, part)) GROUP BY part, entry, i)""",
                 f"""c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(n.q, c.q) AS q FROM c{r} c LEFT JOIN (
        SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM m{r} GROUP BY part, entry) n
      ON c.part = n.part AND c.entry = n.entry)"""]
    return "WITH " + ",\n".join([*ctes, f"f AS MATERIALIZED ({near.format(r=rounds)})", f"""x AS (
      SELECT k.vec_id, k.label, g.code, g.error FROM k JOIN (SELECT rid, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY part) AS code,
        CAST(sum(d) AS BIGINT) AS error FROM f GROUP BY rid) g USING (rid))"""]) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256 FROM x"""


@query("op12_vector_codes", _codes_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = part_codes.encode(table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(part_codes.books_sha256(books)).alias("codebooks_sha256"))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_file("byte_bpe_50k.json"), public_file("piece_bpe_32k.model"))
