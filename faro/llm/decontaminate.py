"""Benchmark decontamination by a broadcast hash set of word windows (DataFrame functions only).

A window is ``n`` consecutive words of a benchmark item (all of a shorter
item's words).  A window of L words holds at least one block of
b = (L + 1) // 2 words that starts at a multiple of b in the document, so a
document is probed once every b words: its block against the broadcast set of
all benchmark blocks of b words.  Only around a block that is met are the L - b + 1
windows built and verified word by word against the broadcast windows
(the join compares the whole strings, not hashes).

Scale: one scan of the documents, no shuffle of text; what is shuffled is one
marker row per document and the verified hits.  Long texts are cut into
chunks that overlap by a window.  The benchmark is broadcast only after its
windows are counted; beyond ``max_broadcast`` of them the same joins run as
shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faro.llm.common import UPPER, ascii_lower, cut, fresh

WORD = r"[0-9a-z\x{80}-\x{10FFFF}]++"                # of lower-cased text; the same as [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
RAW_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]++"
CHUNK = 20000                                          # words of a chunk
PROBE = "array<struct<len:int,at:int,skip:int,ctx:array<string>>>"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), 0), F.array().cast("array<string>"))


def _line(ws: Column, start: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(ws, start, n), " ")


def windows(items: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(len, w, item_ids): every window of the benchmark with the ids (as text) of the items that hold it."""
    it = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("ws")).filter(F.size("ws") > 0)
    size = F.least(F.size("ws"), F.lit(n))
    each = it.select("item", size.alias("len"), F.explode(F.transform(F.sequence(F.lit(1), F.size("ws") - size + 1), lambda i: _line(F.col("ws"), i, size))).alias("w"))
    return each.groupBy("len", "w").agg(F.collect_set("item").alias("item_ids"))


def _sided(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _probes(cw: Column, length: int) -> Column:
    """Every block of the chunk's words with the words around it that a window of ``length`` over it can take in."""
    b = (length + 1) // 2
    side = length - b

    def probe(j: Column) -> Column:
        at, skip = F.greatest(j - side, F.lit(0)), F.least(j, F.lit(side))
        return F.struct(F.lit(length).alias("len"), at.alias("at"), skip.alias("skip"), F.slice(cw, at + 1, skip + length).alias("ctx"))

    return F.transform(F.sequence(F.lit(0), F.size(cw) - b, F.lit(b)), probe)


def hits(docs: DataFrame, items: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", max_broadcast: int = 200_000) -> DataFrame:
    """One row per input row: (doc_id, key, n_words, found), found = verified windows (pos, len, item_ids).

    ``key`` is a hash of the text; rows that share id and text are one group
    inside and are given back as often as they came.
    """
    wins = cut(windows(items, n, item_id, item_text))
    lens = sorted((r[0], r[1]) for r in wins.groupBy("len").agg(F.count(F.lit(1))).collect())  # at most n rows
    small = sum(c for _, c in lens) <= max_broadcast
    half = F.floor((F.col("len") + 1) / 2).cast("int")
    blocks = wins.select("len", F.explode(F.transform(F.sequence(F.lit(0), F.col("len") - half), lambda i: F.slice(F.split("w", " "), i + 1, half))).alias("b")) \
                 .select("len", F.array_join("b", " ").alias("blk")).distinct().withColumn("hit", F.lit(True))
    ws = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.lit(5), F.col(text_col)).alias("key"), words(F.col(text_col)).alias("ws"))
    step = F.sequence(F.lit(0), F.greatest(F.size("ws") - 1, F.lit(0)), F.lit(CHUNK))
    chunk = ws.select("doc_id", "key", F.size("ws").alias("n_words"),
                      F.posexplode(F.transform(step, lambda s: F.slice("ws", s + 1, CHUNK + n - 1))).alias("c", "cw"))
    cw, kinds = F.col("cw"), []
    marker = F.struct(F.lit(0).alias("len"), F.lit(-1).alias("at"), F.lit(None).cast("int").alias("skip"), F.lit(None).cast("array<string>").alias("ctx"))
    kinds.append(F.when(F.col("c") == 0, F.array(marker)).otherwise(F.array().cast(PROBE)))
    kinds += [F.when(F.size(cw) >= length, _probes(cw, length)).otherwise(F.array().cast(PROBE)) for length, _ in lens]
    probe = chunk.select("doc_id", "key", "n_words", "c", F.explode(F.concat(*kinds)).alias("p")).select("doc_id", "key", "n_words", "c", "p.*")
    blk = F.array_join(F.slice("ctx", F.col("skip") + 1, F.floor((F.col("len") + 1) / 2).cast("int")), " ")
    met = probe.withColumn("blk", blk).join(_sided(blocks, small), ["len", "blk"], "left").filter("hit or at = -1")
    near = F.when(F.col("at") >= 0, F.transform(F.sequence(F.lit(0), F.size("ctx") - F.col("len")), lambda i: F.struct(
        (F.col("c") * CHUNK + F.col("at") + i).alias("pos"), _line(F.col("ctx"), i + 1, F.col("len")).alias("w"))))
    full = met.filter("at = -1 or size(ctx) >= len").select("doc_id", "key", "n_words", "at", "len", F.explode_outer(near).alias("x")) \
              .select("doc_id", "key", "n_words", "at", "len", "x.pos", "x.w")
    full = full.join(_sided(wins, small), ["len", "w"], "left").filter("at = -1 or item_ids is not null")
    found = full.groupBy("doc_id", "key", "n_words").agg(
        F.count_if(F.col("at") == -1).alias("copies"), F.collect_set(F.when(F.col("at") >= 0, F.struct("pos", "len", "item_ids"))).alias("found"))
    return found.select("doc_id", "key", F.col("n_words").cast("long").alias("n_words"), "found", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def covered(found: Column) -> Column:
    """Positions of the words inside any found window, each once."""
    return F.array_distinct(F.flatten(F.transform(found, lambda x: F.sequence(x["pos"], x["pos"] + x["len"] - 1))))


def report(docs: DataFrame, items: DataFrame, n: int = 10, **names) -> DataFrame:
    """One row per document: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated).

    Edge cases: null, empty and wordless texts have no words and no hit;
    items without words have no window; an item without an id makes hits but
    is not listed.  Repeated rows are reported each; an empty benchmark hits
    nothing.  Other columns are not read.
    """
    h = hits(docs, items, n, **names)
    ids = F.array_sort(F.array_distinct(F.flatten(F.col("found.item_ids"))))
    h = h.withColumn("n_hit", F.size(covered(F.col("found"))).cast("long")).withColumn("ids", ids)
    return h.select("doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
                    F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10, remove: str = "documents", id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """``docs`` without what the benchmark contaminates: whole documents, or with ``remove='spans'`` the hit words
    (with the separators that follow them) of otherwise kept documents.  Columns and clean rows are unchanged.

    Null and empty texts hold no window and are kept, and so is everything where
    the benchmark is empty; repeated rows and null ids are judged by their text.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    bad = hits(docs, items, n, id_col=id_col, text_col=text_col, **names).filter(F.size("found") > 0)
    bad = bad.groupBy("doc_id", "key").agg(F.first("found").alias("found"))
    i, k, cov = fresh(docs, "hit_id"), fresh(docs, "hit_key"), fresh(docs, "hit_words")
    bad = bad.select(F.col("doc_id").alias(i), F.col("key").alias(k), covered(F.col("found")).alias(cov))
    on = docs[id_col].eqNullSafe(bad[i]) & (F.xxhash64(F.lit(5), docs[text_col]) == bad[k])
    if remove == "documents":
        return docs.join(bad, on, "left_anti")
    parts = F.regexp_extract_all(F.col(text_col), F.lit(rf"{RAW_WORD}[^0-9A-Za-z\x{{80}}-\x{{10FFFF}}]*+"), 0)
    lead = F.regexp_extract(F.col(text_col), r"^[^0-9A-Za-z\x{80}-\x{10FFFF}]*+", 0)
    rest = F.array_join(F.filter(parts, lambda x, j: ~F.array_contains(F.col(cov), j)), "")
    out = docs.join(bad, on, "left").withColumn(text_col, F.when(F.col(cov).isNull(), F.col(text_col)).otherwise(F.concat(lead, rest)))
    return out.drop(i, k, cov)


def oracle(n: int = 10) -> str:
    """DuckDB SQL for the query ``op4_decontaminate``."""
    def ws(t: str) -> str:
        return f"regexp_extract_all(translate(coalesce({t}, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

    return f"""WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {ws('text')} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(ws), {n}) AS l, unnest(list_transform(range(1, CAST(len(ws) - least(len(ws), {n}) + 2 AS BIGINT)), lambda i: array_to_string(ws[i:i + least(len(ws), {n}) - 1], ' '))) AS w FROM b WHERE len(ws) > 0),
d AS (SELECT doc_id, row_number() OVER () AS r, {ws('text')} AS ws FROM documents),
dw AS (SELECT r, l, unnest(range(1, CAST(len(ws) - l + 2 AS BIGINT))) AS pos, unnest(list_transform(range(1, CAST(len(ws) - l + 2 AS BIGINT)), lambda i: array_to_string(ws[i:i + l - 1], ' '))) AS w
 FROM d, (SELECT DISTINCT l FROM bw) WHERE len(ws) >= l),
h AS (SELECT r, pos, bw.l AS l, item FROM dw JOIN bw USING (w)),
p AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(pos, pos + l)) AS x FROM h) GROUP BY r),
i AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM h GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
 sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN p USING (r) LEFT JOIN i USING (r)"""
