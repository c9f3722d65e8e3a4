"""Document fingerprints by winnowing, as built-in column expressions.

A text is a sequence of units: its words, or its characters when it has fewer than
``char_below`` of them (so that short texts have enough units). A word of more than
``LONG_WORD`` characters counts as its characters, so texts without blanks have units too.
Every run of k units is hashed; each window of w consecutive hashes keeps its least one, of equals the rightmost;
positions kept by several windows count once. Any run of at least ``k + w - 1`` units that
two texts (of the same kind of unit) share puts a common hash into both fingerprints, and
no hash comes from fewer than k units.

``edited_likeness`` gives every text its word fingerprint, and a short text its character
fingerprint besides: two short texts are compared by both, any other pair by words, so the
guarantee for ``K + W - 1`` shared words holds between any two texts, whatever their lengths.
The published fingerprint keeps the kinds apart (words, then ``|`` and characters), so that the
likeness of two texts can be told from their fingerprints alone.

The window minima take about log2(w) array passes: a value carries the upper hash bits and the
negated position, so one ``least`` decides hash and tie together. Everything is a
projection over the row: no shuffle, no user function.

Defined results: a null or unit-less text has an empty fingerprint (two empty ones are
equal, likeness 1); a text of fewer than k units has one hash of all its units; with fewer
than w hashes the least one is kept; equal texts have equal fingerprints; repeated rows
each get theirs; an empty table gives no rows; other columns pass through (a column named
like the result is replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.session import materialize

from .common import fresh, words

K, W, CHAR_K, CHAR_W, CHAR_BELOW, LONG_WORD = 3, 12, 5, 4, 512, 64
_POSITION = (1 << 28) - 1  # low bits of a window value hold the negated position


def _offsets(w: int) -> list[int]:
    """Distances whose successive pairwise minima span w values: 1, 2, 4, ... and the rest."""
    out, span = [], 1
    while span < w:
        out.append(min(span, w - span))
        span += out[-1]
    return out


def _units(text: Column) -> Column:
    """The words; a long one gives its characters instead."""
    w = words(text)
    long = rf"[^\x20\x09-\x0D]{{{LONG_WORD + 1}}}"
    chars = F.flatten(F.transform(w, lambda x: F.when(F.length(x) > LONG_WORD, F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0)))
                                  .otherwise(F.array(x))))
    return F.when(F.coalesce(text, F.lit("")).rlike(long), chars).otherwise(w)


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint", k: int = K, w: int = W,
                char_k: int = CHAR_K, char_w: int = CHAR_W, char_below: int = CHAR_BELOW) -> DataFrame:
    """Add ``out``: array of (hash, position) in text order, positions counted in units."""
    keep = [c for c in df.columns if c != out or c == text]
    df = df.select(*keep)
    short, u, h, m, p = (fresh(df, x) for x in ("short", "units", "hashes", "minima", "places"))
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn(short, F.length(t) < char_below)
    df = df.withColumn(u, F.when(F.col(short), F.regexp_extract_all(t, F.lit("(?s)."), F.lit(0))).otherwise(_units(F.col(text))))
    gram = lambda n: f"transform(sequence(0, size({u}) - {n}), i -> xxhash64({', '.join(f'{u}[i + {j}]' for j in range(n))}))"
    df = df.withColumn(h, F.expr(f"""CASE WHEN size({u}) = 0 THEN cast(array() AS array<bigint>)
        WHEN size({u}) < if({short}, {char_k}, {k}) THEN array(xxhash64({u}))
        WHEN {short} THEN {gram(char_k)} ELSE {gram(k)} END"""))
    df = df.withColumn(m, F.expr(f"transform({h}, (x, i) -> (x & {~_POSITION}) | ({_POSITION} - i))"))
    df = df.withColumn(m, F.expr(f"CASE WHEN size({m}) > if({short}, {char_w}, {w}) OR size({m}) = 0 THEN {m} ELSE array(array_min({m})) END"))
    at_w, at_c = _offsets(w), _offsets(char_w)
    for j in range(max(len(at_w), len(at_c))):
        step = lambda a: (f"transform(sequence(0, size({m}) - 1 - {a[j]}), i -> least({m}[i], {m}[i + {a[j]}]))" if j < len(a) else m)
        df = df.withColumn(m, F.expr(f"CASE WHEN size({m}) < 2 THEN {m} WHEN {short} THEN {step(at_c)} ELSE {step(at_w)} END"))
    df = df.withColumn(p, F.array_distinct(F.expr(f"transform({m}, x -> cast({_POSITION} - (x & {_POSITION}) AS int))")))
    return df.withColumn(out, F.expr(f"transform({p}, i -> struct({h}[i] AS hash, i AS position))")).select(*keep, out)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two arrays of hashes; 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        both / F.greatest(F.lit(1), F.size(F.array_union(a, b))))


def hashes(fp: Column) -> Column:
    return F.array_distinct(F.transform(fp, lambda x: x["hash"]))


def unit_hashes(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the hashes ``w`` of the words and ``c`` of the characters (null unless the text is short)."""
    short, c, w = (fresh(df, x) for x in ("short_text", "by_char", "by_word"))
    keep = [x for x in df.columns if x != out]
    df = fingerprint(df, text, w, char_below=0)
    df = df.withColumn(short, F.when(F.length(text) < CHAR_BELOW, F.col(text)))
    df = fingerprint(df, short, c)
    by_char = F.when(F.col(short).isNotNull(), hashes(F.col(c)))
    return df.select(*keep, F.struct(hashes(F.col(w)).alias("w"), by_char.alias("c")).alias(out))


def every_hash(u: Column) -> Column:
    """Word and character hashes of a text as one array."""
    return F.when(u["c"].isNull(), u["w"]).otherwise(F.array_distinct(F.concat(u["c"], u["w"])))


def pair_likeness(a: Column, b: Column) -> Column:
    """Likeness of two texts: by all hashes if both are short, else by words."""
    both = a["c"].isNotNull() & b["c"].isNotNull()
    return F.when(both, likeness(every_hash(a), every_hash(b))).otherwise(likeness(a["w"], b["w"]))


def as_text(fp: Column) -> Column:
    """A fingerprint as text: hashes in text order, hexadecimal."""
    return F.array_join(F.transform(fp, lambda x: F.lower(F.hex(x))), " ")


def published(u: Column) -> Column:
    """The word hashes and, if the text is short, ``|`` and the character hashes."""
    return F.when(F.coalesce(F.size(u["c"]), F.lit(0)) > 0, F.concat_ws(" | ", as_text(u["w"]), as_text(u["c"]))).otherwise(as_text(u["w"]))


def next_ids(ids: DataFrame, id: str) -> DataFrame:
    """(id, next_id) for every distinct id: the next larger one, the least after the last.

    Ids are dealt into ranges (a written table, so the ranges are fixed), neighbours are
    found inside a range, and the first id of each later range closes the gap between them."""
    ranged = materialize(ids.select(id).where(F.col(id).isNotNull()).distinct().repartitionByRange(id)
                         .withColumn("__range", F.spark_partition_id()), "winnow-ids")
    firsts = ranged.groupBy("__range").agg(F.min(id).alias("__first"))  # one row per range
    after = F.lead("__first").over(Window.orderBy("__range"))
    least = F.min("__first").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    borders = firsts.select("__range", F.coalesce(after, least).alias("__after"))
    inside = F.lead(id).over(Window.partitionBy("__range").orderBy(id))
    return ranged.withColumn("__in", inside).join(borders, "__range").select(id, F.coalesce("__in", "__after").alias("next_id"))


def edited_likeness(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (its last quarter replaced by the
    beginning of the next document's), with their likeness. Rows with a null id have no
    next document and are edited to a shorter text; of rows sharing an id, the greatest
    text serves as "next"."""
    base = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    every = unit_hashes(base, "text", "fp").select("id", "text", "fp")
    # both joins below read the very same rows, so their shuffle by id is made once
    fp = every.where("id IS NOT NULL")
    nxt = next_ids(base, "id")
    quarter = F.floor(F.length("text") / 4).cast("int")
    sizes = base.select("id", quarter.alias("q"))  # before the join, so that no text is shuffled for it
    need = sizes.join(nxt, "id").groupBy(F.col("next_id").alias("id"), F.col("id").alias("before")).agg(F.max("q").alias("need"))
    heads = (fp.join(need, "id").select(F.col("before").alias("id"), F.expr("left(text, need)").alias("head"), F.col("fp").alias("next_fp"))
             .groupBy("id").agg(F.max(F.struct("head", "next_fp")).alias("h")).select("id", "h.*"))
    none = F.expr("named_struct('w', cast(array() AS array<bigint>), 'c', cast(array() AS array<bigint>))")
    alone = every.where("id IS NULL").withColumns({"head": F.lit(""), "next_fp": none})
    joined = (fp.join(heads, "id", "left").unionByName(alone).withColumn("head", F.coalesce("head", F.lit("")))
              .withColumn("next_fp", F.coalesce("next_fp", none))
              .withColumn("n", F.length("text").cast("long")).withColumn("q", quarter))
    edited = joined.withColumn("edited", F.expr("concat(left(text, int(n - q)), left(head, q))"))
    edited = unit_hashes(edited, "edited", "edited_fp")
    return edited.select(F.col("id").alias(id), F.col("n").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                         published(F.col("fp")).alias("fingerprint"), published(F.col("edited_fp")).alias("edited_fingerprint"),
                         pair_likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                         pair_likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
