"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm import block_neighbours, curriculum, decontamination, hard_negatives, impact_index, jaccard_join, licenses, ns_clustering, packing, pii, quality_mil, secret_scan, sharding
from silverline.llm.common import bounded_batches, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_impact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_index.impact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP2_SQL = """
WITH held AS (
    SELECT vec_id, min(embedding) AS vector FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id),
whole AS (SELECT vec_id, list_transform(vector, lambda x: floor(256 * x::DOUBLE)) AS vector FROM held),
scored AS (
    SELECT q.vec_id AS query_id, v.vec_id,
        coalesce(list_sum(list_transform(list_zip(q.vector, v.vector), lambda z: z[1] * z[2])), 0)::BIGINT AS score
    FROM whole q JOIN whole v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op3_recursive_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op4_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op5_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 8)


def op6_diagonal_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op7_t_occurrence_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 80 * (x.n + y.n - c)),
reached AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN reached r ON r.a = d.doc_id GROUP BY d.doc_id
"""


def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix with the positions of all copies, on the scale of all words, as text: lists differ between clients."""
    mixed = curriculum.mix_sources(table(spark, sf_dir, "documents")).drop("first_position", "positions")
    return mixed.withColumn("word_positions", F.array_join(F.col("word_positions").cast("array<string>"), ","))


OP8_SQL = r"""
WITH docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        md5(coalesce(doc_id::VARCHAR, '')) AS key
    FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, 3 * source_size AS lim FROM sizes),
weighted AS (SELECT *, (rank % 3 + 1)::BIGINT AS weight FROM ranked),
levels AS (
    SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(lim) OVER earlier, 0)::DOUBLE)
        / ((sum(weight) OVER ())::DOUBLE - coalesce(sum(weight) OVER earlier, 0)::DOUBLE) AS level
    FROM weighted
    WINDOW earlier AS (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT level FROM levels WHERE lim >= level * weight ORDER BY lim / weight, rank LIMIT 1),
targets AS (
    SELECT l.source, l.source_size, least(l.lim::DOUBLE, c.level * l.weight) AS target FROM levels l, chosen c),
placed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM docs),
mixed AS (
    SELECT p.doc_id, p.size, p.before, t.source_size, t.target, r.rank, (SELECT sum(size) FROM docs)::BIGINT AS total,
        (CASE r.rank % 3 WHEN 0 THEN -0.5 WHEN 1 THEN 0 ELSE 0.5 END)::DOUBLE AS slope,
        CASE WHEN t.source_size > 0
            THEN greatest(ceil((t.target - p.before - p.size / 2) / t.source_size), 0)::INTEGER ELSE 0 END AS copies
    FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source JOIN ranked r ON p.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, copies::BIGINT * size AS taken, copies,
    array_to_string(list_transform(list_transform(range(copies), lambda c: (before + c * source_size + size / 2) / target),
        lambda x: floor(2 * x / ((1 - slope) + sqrt(greatest((1 - slope) * (1 - slope) + 4 * slope * x, 0))) * total)::BIGINT), ',') AS word_positions
FROM mixed
"""

def op9_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_neighbours.block_nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP10_SQL = """
WITH held AS (
    SELECT vec_id, min(embedding) AS vector FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    GROUP BY vec_id),
scored AS (
    SELECT q.vec_id AS query_id, v.vec_id,
        list_reduce(list_transform(list_zip(q.vector, v.vector), lambda z: z[1]::DOUBLE * z[2]::DOUBLE), lambda a, b: a + b) AS score
    FROM held q JOIN held v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def op11_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


OP11_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS k, doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents),
items AS (
    SELECT item_id::VARCHAR AS item, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT item, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
begun AS (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized),
windows AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM begun),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT k, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM docs, lengths),
found AS (
    SELECT p.k, p.i, p.n, x.item FROM places p JOIN windows x ON x.n = p.n AND x.words = array_to_string(p.w[p.i:p.i + p.n - 1], ' ')),
hit AS (SELECT k, count(DISTINCT place) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS place FROM found) GROUP BY k),
listed AS (
    SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT k, item FROM found WHERE item IS NOT NULL) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (k) LEFT JOIN listed USING (k)
"""


def op12_cover_tree_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


OP12_SQL = """
WITH held AS MATERIALIZED (
    SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.k, a.vec_id AS anchor_id, a.label = v.label AS same, v.k AS other, v.vec_id,
        coalesce(list_sum(list_transform(list_zip(a.vector, v.vector), lambda z: z[1] * z[2])), 0)::BIGINT AS score
    FROM held a JOIN held v ON a.vec_id % 100 = 0 AND a.k <> v.k),
positives AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id, other) AS place FROM scored WHERE same),
ranked AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.k, p.place ORDER BY n.score DESC, n.vec_id, n.other)::INTEGER AS rank
    FROM positives p JOIN scored n ON p.k = n.k AND p.place <= 5 AND NOT n.same
        AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""


def op13_ns_bounds_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, history = ns_clustering.cluster(table(spark, sf_dir, "embeddings"))
    return ns_clustering.with_inertia(found, history[-1])


def _op13_sql(rounds: int = 3) -> str:
    """All distances in every round, round after round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
    SELECT k, vec_id, x, c, m, distance FROM (
        SELECT k, vec_id, x, c, m, distance, row_number() OVER (PARTITION BY k ORDER BY distance, c) AS place FROM (
            SELECT *, list_sum(list_transform(list_zip(x, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance FROM kept, c{r}))
    WHERE place = 1)""")
        if r < rounds:
            steps.append(f"""
u{r} AS (SELECT c, d, sum(v)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (SELECT c, unnest(x) AS v, unnest(range(1, 65)) AS d FROM a{r}) GROUP BY c, d),
m{r} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY d) AS m FROM u{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(m{r}.m, c{r}.m) AS m FROM c{r} LEFT JOIN m{r} ON c{r}.c = m{r}.c)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS k, vec_id,
        list_transform(embedding, lambda x: floor(greatest(-134217728, least(134217728, 64 * x::DOUBLE)))::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
hashed AS (SELECT x, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS c FROM kept),
c0 AS MATERIALIZED (SELECT c, x AS m FROM hashed WHERE c < 16),{",".join(steps)}
SELECT vec_id, c::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds}
"""


OP13_SQL = _op13_sql()


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # stands beside this library, at the top of the repository

    return corpus_pipeline.run(spark, sf_dir)


def _bounded(run: Query) -> Query:
    return lambda spark, sf_dir: run(bounded_batches(spark), sf_dir)


_QUERIES: dict[str, Query] = {
    "op1_best_two_fit_packing": op1_best_two_fit_packing,
    "op2_impact_top_k": op2_impact_top_k,
    "op3_recursive_secret_scan": op3_recursive_secret_scan,
    "op4_deobfuscated_pii": op4_deobfuscated_pii,
    "op5_hash_tree_sharding": op5_hash_tree_sharding,
    "op6_diagonal_license_scan": op6_diagonal_license_scan,
    "op7_t_occurrence_jaccard": op7_t_occurrence_jaccard,
    "op8_curriculum_mix": op8_curriculum_mix,
    "op9_quality_mil": op9_quality_mil,
    "op10_block_matrix_neighbours": op10_block_matrix_neighbours,
    "op11_fm_index_decontamination": op11_fm_index_decontamination,
    "op12_cover_tree_hard_negatives": op12_cover_tree_hard_negatives,
    "op13_ns_bounds_clustering": op13_ns_bounds_clustering,
    "pipeline": pipeline,
}
QUERIES = {name: _bounded(run) for name, run in _QUERIES.items()}
ORACLES: dict[str, str] = {
    "op2_impact_top_k": OP2_SQL,
    "op7_t_occurrence_jaccard": OP7_SQL,
    "op8_curriculum_mix": OP8_SQL,
    "op10_block_matrix_neighbours": OP10_SQL,
    "op11_fm_index_decontamination": OP11_SQL,
    "op12_cover_tree_hard_negatives": OP12_SQL,
    "op13_ns_bounds_clustering": OP13_SQL,
}
