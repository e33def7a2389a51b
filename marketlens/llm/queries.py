"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Share of characters for each source of the corpus; all others share that of ``*`` equally.
TARGETS = {"src0": 0.20, "src1": 0.10, "src2": 0.10, "src3": 0.10, "*": 0.50}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_int8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    from marketlens.llm import vectors
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


SQL["op1_int8_near_dup"] = """
WITH RECURSIVE ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT c.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM component c LEFT JOIN n USING (vec_id)"""


@query
def op2_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every 50th embedding."""
    from marketlens.llm import mtree
    return mtree.top_k(table(spark, sf_dir, "embeddings"))


SQL["op2_mtree_top_k"] = """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM ok q JOIN ok c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document."""
    from marketlens.llm import toxicity
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    from marketlens.llm import secret_scan
    return secret_scan.digest(table(spark, sf_dir, "documents"))


@query
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot of every document in the mix."""
    from marketlens.llm import mixing
    return mixing.schedule(table(spark, sf_dir, "documents"), TARGETS).drop("h2")


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    from marketlens.llm import quality
    docs = table(spark, sf_dir, "documents")
    return quality.scores(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from marketlens.llm import html_text
    pages = table(spark, sf_dir, "pages")
    return html_text.extracted(pages, html_text.fit(pages))


@query
def op8_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of every document."""
    from marketlens.llm import class_lm
    return class_lm.corpus_scores(table(spark, sf_dir, "documents"))


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy component of every document."""
    from marketlens.llm import jaccard
    return jaccard.near_copies(table(spark, sf_dir, "documents"))


SQL["op9_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')]
        ELSE list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) END)) AS e FROM w),
n AS (SELECT doc_id, len(e) AS size FROM s),
x AS (SELECT doc_id, unnest(e) AS g FROM s),
both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM both_have JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 90 * (na.size + nb.size - k)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a),
class AS (SELECT doc_id, IF(len(e) = 0, doc_id, min(doc_id) OVER (PARTITION BY e)) AS class_id FROM s),
linked AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, n.size AS n_shingles, component_id, class_id, coalesce(n_links, 0) AS n_links
FROM n JOIN component USING (doc_id) JOIN class USING (doc_id) LEFT JOIN linked USING (doc_id)"""


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's tokens and of what they decode to."""
    from marketlens.llm import bpe
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.default_vocabulary())


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened coordinates of every embedding."""
    from marketlens.llm import whitening
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verification of every document."""
    from marketlens.llm import merkle
    return merkle.verified(table(spark, sf_dir, "documents"))


def _merkle_sql(levels: int = 8, tops: int = 8) -> str:
    """The tree by plain grouping, level by level; up to 16^8 rows a source, and as many sources."""
    def field(c: str, text: str | None = None) -> str:
        return f"coalesce(CAST(strlen(CAST({text or c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({text or c} AS VARCHAR), '-')"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf, altered = (" || ".join(field(c, t if c == "text" else None) for c in ("doc_id", "source", "lang", "n_chars", "text")) for t in (None, low))
    crc = ("list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), "
           "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))")
    out = [f"d AS (SELECT doc_id, source, sha256({leaf}) AS leaf, CASE WHEN xor({crc}, 4294967295) % 5 = 0 THEN sha256({altered}) END AS altered FROM documents)",
           "a0 AS MATERIALIZED (SELECT *, source AS tree, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY source) AS n, leaf AS h "
           "FROM d WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf))"]

    def climb(t: str, top: int) -> None:
        for k in range(top):
            side = "coalesce(string_agg(h, '') OVER (PARTITION BY tree, i // 16 ORDER BY i ROWS BETWEEN {}), '')"
            out.append(f"{t}s{k} AS MATERIALIZED (SELECT tree, i, {side.format('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS l, "
                       f"{side.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS r FROM {t}{k} WHERE n > 1)")
            out.append(f"{t}{k + 1} AS MATERIALIZED (SELECT tree, i // 16 AS i, (max(n) + 15) // 16 AS n, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) "
                       f"ELSE max(h) END AS h FROM {t}{k} GROUP BY tree, i // 16)")

    climb("a", levels)
    out.append(f"b0 AS MATERIALIZED (SELECT tree AS source, 0 AS tree, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS i, count(*) OVER () AS n, h FROM a{levels})")
    climb("b", tops)
    out.append("p0 AS (SELECT a0.doc_id, a0.source, a0.leaf, coalesce(a0.altered, a0.leaf) AS f, '' AS proof, a0.i, b0.i AS j, b0.h AS subroot FROM a0 JOIN b0 ON a0.source IS NOT DISTINCT FROM b0.source)")
    for k in range(levels + tops):
        t, m, place = ("a", k, "i") if k < levels else ("b", k - levels, "j")
        tree = "p.source IS NOT DISTINCT FROM s.tree" if t == "a" else "true"
        out.append(f"p{k + 1} AS (SELECT p.* REPLACE (CASE WHEN s.l IS NULL THEN f ELSE sha256(s.l || f || s.r) END AS f, proof || coalesce(s.l || s.r, '') AS proof) "
                   f"FROM p{k} p LEFT JOIN {t}s{m} s ON {tree} AND p.{place} // {16 ** m} = s.i)")
    return (f"WITH {', '.join(out)} SELECT doc_id, leaf, subroot, b{tops}.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = b{tops}.h AS verified "
            f"FROM p{levels + tops}, b{tops}")


SQL["op12_merkle"] = _merkle_sql()


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the lines that every document keeps."""
    from marketlens.llm import lines
    return lines.digest(table(spark, sf_dir, "documents"))


SQL["op13_line_dedup"] = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, 1 + len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count_if(gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
