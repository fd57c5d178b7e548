"""The registered queries of this subpackage: each operator over its whole table, reduced to digests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import bpe, centroids, dialogue, extract, fingerprints, jaccard, language, packing, quality, recount, secrets, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _vocabulary("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(table(spark, sf_dir, "documents"), path).select(
        "doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(bpe.decode("ids", path), 256).alias("decoded_sha256"))


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


# The rank file has the vocabulary of byte_bpe_50k.json but for its added token, and gives its ids at three times the speed (tests
# compare them with the library's).
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"),
                        added=_vocabulary("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def held_out() -> Column:
    """The quarter of the id hashes that languages are not learnt from; a row without id is none of it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs, ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def edit_log(docs: DataFrame) -> DataFrame:
    """Three edits of every document: a cut at a quarter, its own beginning put into the middle, another end."""
    n = F.coalesce(F.length("text"), F.lit(0))
    edits = [(1, F.floor(n / 4), F.floor(n / 4) + 20, F.lit("")),
             (2, F.floor(n / 2), F.floor(n / 2), F.substring("text", 1, 40)),
             (3, n, n + 40, F.lit("'re done.\n"))]
    return docs.select("doc_id", F.inline(F.array(*[F.struct(
        F.lit(seq).alias("seq"), start.cast("bigint").alias("start"), stop.cast("bigint").alias("stop"),
        new.alias("replacement")) for seq, start, stop, new in edits])))


def op7_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return recount.recount(docs, edit_log(docs), _vocabulary("byte_bpe_multi_50k.tiktoken"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def toxicity_held_out() -> Column:
    """The third of the id hashes whose labels are not learnt from; a row without id is none of it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity_held_out())
    return toxicity.score(docs, model).select("doc_id", toxicity_held_out().alias("held_out"), "score",
                                              (F.col("score") >= 0.7).cast("int").alias("predicted"))


def damaged(talks: DataFrame) -> DataFrame:
    """Conversations with faults by a hash of conversation and turn; ``copies`` says how often a row is there."""
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = text_of("text")
    return talks.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(text_of("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"))


def op13_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair(damaged(table(spark, sf_dir, "conversations")), copies=F.col("copies"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_extract": op2_extract,
    "op3_packing": op3_packing,
    "op4_warc": op4_warc,
    "op5_jaccard": op5_jaccard,
    "op6_language": op6_language,
    "op7_recount": op7_recount,
    "op8_secrets": op8_secrets,
    "op9_quality": op9_quality,
    "op10_fingerprints": op10_fingerprints,
    "op11_centroids": op11_centroids,
    "op12_toxicity": op12_toxicity,
    "op13_dialogue": op13_dialogue,
}


def _centroid_sql(rounds: int = 5) -> str:
    """Every distance of every round by inner products, which are whole numbers below 2**53."""
    parts = ["""
        kept AS MATERIALIZED (
            SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v, [floor(256 * x::DOUBLE) FOR x IN embedding] AS d
            FROM embeddings WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF isfinite(x)]) = 64),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v, d FROM kept WHERE vec_id IS NOT NULL
            ORDER BY sha256('2:' || vec_id), v LIMIT 40)"""]
    for t in range(rounds + 1):
        parts.append(f"""
        a{t} AS MATERIALIZED (
            SELECT vec_id, v, unnest(min({{dist: dist, c: c}})) FROM (
                SELECT n, vec_id, k.v, c, (list_inner_product(k.d, k.d) - 2 * list_inner_product(k.d, c{t}.d)
                       + list_inner_product(c{t}.d, c{t}.d))::BIGINT AS dist
                FROM (SELECT *, row_number() OVER () AS n FROM kept) k CROSS JOIN c{t}) GROUP BY n, vec_id, v)""")
        if t < rounds:
            parts.append(f"""
        c{t + 1} AS MATERIALIZED (
            SELECT c, w AS v, w::DOUBLE[] AS d FROM (
                SELECT c{t}.c, coalesce(m.w, c{t}.v) AS w FROM c{t} LEFT JOIN (
                    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS w FROM (
                        SELECT c, i, sum(v[i])::HUGEINT AS s, count(*) AS n FROM a{t}, range(1, 65) r(i) GROUP BY c, i)
                    GROUP BY c) m ON m.c = c{t}.c))""")
    return f"""
        WITH {",".join(parts)}
        SELECT vec_id, c::INTEGER AS cluster, dist AS distance, (sum(dist) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
               (sum(dist) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} USING (c)"""


ORACLES: dict[str, str] = {
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
        last AS (SELECT html, max(page_id) AS page_id FROM p WHERE n >= 1000 GROUP BY html)
        SELECT p.page_id, p.n AS payload_bytes, sha1(p.html) AS payload_digest,
               CASE WHEN last.page_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN last.page_id <> p.page_id THEN last.page_id END AS refers_to
        FROM p LEFT JOIN last USING (html)""",
    "op5_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
            FROM words),
        sorted AS (SELECT doc_id, list_sort(s) AS s FROM sets),
        classes AS (SELECT min(doc_id) AS c, s, len(s) AS n FROM sorted WHERE len(s) > 0 GROUP BY s),
        items AS (SELECT c, n, unnest(s) AS item FROM classes),
        pairs AS (
            SELECT a.c AS x, b.c AS y FROM items a JOIN items b ON a.item = b.item AND a.c < b.c
            GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
        reach(c, root) AS (
            SELECT c, c FROM classes UNION SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.c),
        roots AS (SELECT c, min(root) AS component_id FROM reach GROUP BY c)
        SELECT sorted.doc_id, len(sorted.s) AS n_shingles, coalesce(roots.component_id, sorted.doc_id) AS component_id
        FROM sorted LEFT JOIN classes USING (s) LEFT JOIN roots USING (c)""",
    "op11_centroids": _centroid_sql(),
    "op13_dialogue": r"""
        WITH RECURSIVE hashed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(
                       coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')]),
                   lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i:
                       xor(r >> 1, CASE WHEN (r & 1) = 1 THEN 3988292384 ELSE 0 END)))) % 20 AS kind
            FROM conversations),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM hashed, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM damaged),
        judged AS (
            SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS seen,
                   NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS previous
            FROM placed),
        r AS MATERIALIZED (
            SELECT conv_id, turn, pos, role, text, initial, blank, seen AND NOT blank AS duplicate,
                   cut AND NOT blank AND NOT seen AS truncated,
                   previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au') AS illegal FROM judged),
        inserts(state, mid, letters) AS (VALUES (0, 0, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 1, ''), (1, 2, 'I'), (1, 3, 'II'),
            (2, 2, ''), (2, 3, 'I'), (3, 3, ''), (3, 2, 'I')),
        acts(mid, letter, initial, state) AS (VALUES (0, 'D', NULL, 0), (1, 'D', NULL, 1), (2, 'D', NULL, 2), (3, 'D', NULL, 3),
            (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3),
            (0, 'R', NULL, 2), (1, 'R', NULL, 2), (3, 'R', NULL, 2), (2, 'R', NULL, 3)),
        ways(conv_id, pos, state, best) AS (
            SELECT DISTINCT conv_id, 0::BIGINT, 0, {cost: 0::BIGINT, audit: ''} FROM conversations
            UNION ALL
            SELECT w.conv_id, r.pos, a.state, min({
                cost: (w.best.cost + 3 * length(i.letters) + CASE letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                       + CASE WHEN truncated AND letter <> 'D' THEN 3 ELSE 0 END)::BIGINT,
                audit: w.best.audit || i.letters || letter})
            FROM ways w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1
            JOIN inserts i ON i.state = w.state JOIN acts a ON a.mid = i.mid AND (letter = 'D' OR NOT blank AND NOT duplicate
                AND (a.initial IS NULL OR a.initial = r.initial))
            GROUP BY w.conv_id, r.pos, a.state),
        sizes AS (SELECT conv_id, max(pos) AS n FROM ways GROUP BY conv_id),
        ends AS (
            SELECT w.conv_id, min({cost: (w.best.cost + 3 * length(i.letters))::BIGINT, audit: w.best.audit || i.letters}) AS best
            FROM ways w JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.pos
            JOIN inserts i ON i.state = w.state WHERE i.mid IN (0, 3) GROUP BY w.conv_id),
        letters AS (
            SELECT conv_id, i, best.audit[i] AS letter,
                   length(replace(left(best.audit, i), 'I', '')) AS pos, length(replace(left(best.audit, i), 'D', '')) AS nth
            FROM ends, range(1, length(best.audit) + 1) t(i)),
        lines AS (
            SELECT l.conv_id, i, letter, r.role, CASE WHEN letter = 'I' THEN '' ELSE r.text END AS text,
                   nth - max(CASE WHEN letter = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS place
            FROM letters l LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.pos = l.pos WHERE letter <> 'D'),
        repaired AS (
            SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END
                || ':' || text, chr(10) ORDER BY i) AS body FROM lines GROUP BY conv_id),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
                   count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
                   count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
            FROM r GROUP BY conv_id)
        SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
               sha256(coalesce(body, '')) AS repaired_sha256
        FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
        LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM e.conv_id""",
}
