"""Line dedup (operator 13): lines that several documents hold stay in one of them only.

Each text is split at ``\\n``; a line's key is the line without the white space ``[\\x20\\x09-\\x0D]`` at both
ends and with A-Z in lower case. Keys are hashed to 128 bits, the distinct documents of each hash are counted,
and the lines whose key is in ``min_docs`` documents or more go from every document but the one with the smallest id.
The kept lines are joined again by position. SQL functions only, from the scan to the result.

Hot keys: distinct documents are counted in two aggregations (by hash and document, then by hash), so a key that
a third of the documents hold is split over documents before it is one row. Keys held by more than one in ``HOT_SHARE`` of all
(key, document) pairs number fewer than ``HOT_SHARE``: they alone are broadcast, and their lines take keys that nothing has in the shuffle join.

Defined results: a null text is the empty text, which is one empty line. Rows of one ``doc_id`` are one document; null ids
are one document too, which ranks after all numbers. Equal rows each give a row of the result. Copies of a line within the kept
document all stay. Further columns of the input, also clashing ones, are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.base import pick, saved

MIN_CHARS = 10
MIN_DOCS = 2
#: FIXED VALUES: white space of the contract, and the letters it lowers
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOT_SHARE = 10_000

_ROW = ["r1", "r2"]     # a row's identity: two hashes of its id and text
_KEY = ["h1", "h2"]     # a key's: two hashes of the key


def _hashes(*cols: Column, names: list[str]) -> list[Column]:
    """128 bits in two columns: 64-bit hashes begun by different words."""
    return [F.xxhash64(F.lit(name), *cols).alias(name) for name in names]


def _rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, r1, r2)``; the result of a row depends on its id and text only, so equal rows share an identity."""
    out = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return out.select("doc_id", "text", *_hashes(F.col("doc_id"), F.col("text"), names=_ROW))


def _keys(rows: DataFrame, min_chars: int) -> DataFrame:
    """``(doc_id, r1, r2, pos, h1, h2)`` of every line whose key is long enough."""
    lines = rows.select("doc_id", *_ROW, F.posexplode(F.split(F.translate("text", UPPER, LOWER), "\n", -1)).alias("pos", "line"))
    lines = lines.select("doc_id", *_ROW, "pos", F.btrim("line", F.lit(SPACE)).alias("key")).filter(F.length("key") >= min_chars)
    return lines.select("doc_id", *_ROW, "pos", *_hashes(F.col("key"), names=_KEY))


def repeated_keys(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(h1, h2, n_docs, keeper)`` of each key in ``min_docs`` documents or more; ``keeper`` is the smallest id that holds it."""
    per_doc = _keys(_rows(docs), min_chars).select(*_KEY, "doc_id").distinct()
    return (per_doc.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("keeper"))
            .filter(F.col("n_docs") >= min_docs))


def without_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, text, n_lines, n_dropped)``: every document with the lines it keeps, the number of its lines
    before, and the number dropped."""
    rows = _rows(docs)
    found = saved(repeated_keys(docs, min_docs, min_chars), "ld-keys")
    total = found.agg(F.sum("n_docs")).first()[0] or 0
    # sum(n_docs) >= n_hot * total / HOT_SHARE, so there are at most HOT_SHARE hot keys
    hot = found.filter(F.col("n_docs") * HOT_SHARE > F.lit(total)).select(*_KEY, F.col("keeper").alias("hot_keeper"), F.lit(True).alias("hot"))
    lines = _keys(rows, min_chars).join(F.broadcast(hot), _KEY, "left")
    spread = [F.when(F.col("hot"), F.xxhash64(*_ROW, "pos", F.lit(k))).otherwise(F.col(k)).alias(k) for k in _KEY]
    lines = lines.select("doc_id", *_ROW, "pos", "hot", "hot_keeper", *spread)
    cold = found.filter(F.col("n_docs") * HOT_SHARE <= F.lit(total)).select(*_KEY, "keeper", F.lit(True).alias("cold"))
    met = lines.join(cold, _KEY, "left").filter(F.col("hot") | F.col("cold"))
    keeper = F.when(F.col("hot"), F.col("hot_keeper")).otherwise(F.col("keeper"))
    dropped = met.filter(~F.col("doc_id").eqNullSafe(keeper)).groupBy(*_ROW).agg(F.collect_set("pos").alias("gone"))
    out = rows.join(dropped, _ROW, "left")
    out = out.select("doc_id", F.split("text", "\n", -1).alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.when(F.size("gone") == 0, F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    return out.select("doc_id", text.alias("text"), F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"))


def digest(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)`` of every document."""
    out = without_repeated_lines(docs, min_docs, min_chars)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
