"""The registered queries of this package, each beside the DuckDB SQL for its rows where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.centroids import cluster
from tabulon.llm.chunks import repeated_chunks
from tabulon.llm.common import table
from tabulon.llm.fill_in_middle import RESULTS, fill_in_middle, restored
from tabulon.llm.lines import drop_boilerplate
from tabulon.llm.mixing import mix_sources
from tabulon.llm.near import near_duplicates
from tabulon.llm.neighbours import nearest
from tabulon.llm.packing import pack_pow2
from tabulon.llm.pii import find_pii
from tabulon.llm.quality import quality
from tabulon.llm.suffixes import remove_repeats
from tabulon.llm.token_files import read_tokens, write_tokens
from tabulon.llm.tokens import tokenizer_path
from tabulon.llm.topk import top_k
from tabulon.plans.registry import query, rounded
from tabulon.session import scratch_path


LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, coalesce(source, '') AS host, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS k
  FROM documents
), t AS (
  SELECT *, trim(line, E' \t\n\x0B\x0C\r') AS key FROM l
), n AS (
  SELECT host, key, count(DISTINCT doc_id) AS n FROM t WHERE key <> '' GROUP BY host, key
), b AS (
  SELECT host, key FROM n
  JOIN (SELECT coalesce(source, '') AS host, count(*) AS pages FROM documents GROUP BY 1) USING (host)
  WHERE n >= 2 AND pages >= 10 AND n > 0.1 * pages
), k AS (
  SELECT doc_id, count(*) AS n_lines, count(b.key) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (b.key IS NULL), '') AS text
  FROM t LEFT JOIN b USING (host, key) GROUP BY doc_id
)
SELECT d.doc_id, k.text, d.lang, d.source, d.n_chars, coalesce(n_lines, 0)::BIGINT AS n_lines,
       coalesce(n_dropped, 0)::BIGINT AS n_dropped
FROM documents d LEFT JOIN k USING (doc_id)
"""


@query("op1_lines", LINES_SQL)
def op1_lines(spark: SparkSession, folder: str) -> DataFrame:
    return drop_boilerplate(table(spark, folder, "documents"))


QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), c AS (
  SELECT doc_id, lang, words, lines,
         [length(regexp_replace(text, '[^a-z]+', '', 'g')), length(regexp_replace(text, '[^\x20\x09-\x0D]+', '', 'g')),
          length(regexp_replace(text, '[^A-Z]+', '', 'g')), length(regexp_replace(text, '[^0-9]+', '', 'g')),
          length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')),
          length(regexp_replace(regexp_replace(text, '[#*$%&|<>]+', '', 'g'), '[^!-/:-@\[-`{-~]+', '', 'g')),
          length(regexp_replace(text, '[\x09-\x0D\x20-\x7E]+', '', 'g'))] AS classes
  FROM d
), w AS (
  SELECT doc_id, words[i] AS w1, words[i + 1] AS w2, words[i + 2] AS w3, i
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY doc_id, w1, w2, w3) > 1
), r AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id
), v AS (
  SELECT lang, word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS rank
  FROM (SELECT lang, unnest(words) AS word FROM d) GROUP BY lang, word
), refwords AS (
  SELECT lang, rank, word, n / sum(n) OVER (PARTITION BY lang) AS q FROM v
), tops AS (
  SELECT lang, rank, word, q FROM refwords WHERE rank <= 16
  UNION ALL SELECT lang, 17, NULL, 1 - sum(q) FROM refwords WHERE rank <= 16 GROUP BY lang
), ref_classes AS (
  SELECT lang, k, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q
  FROM (SELECT lang, unnest(classes) AS n, unnest(range(1, 8)) AS k FROM c) GROUP BY lang, k
), own_classes AS (
  SELECT doc_id, lang, k, n / nullif(sum(n) OVER (PARTITION BY doc_id), 0) AS p
  FROM (SELECT doc_id, lang, unnest(classes) AS n, unnest(range(1, 8)) AS k FROM c)
), cd AS (
  SELECT doc_id, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                                    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS dist
  FROM (SELECT doc_id, coalesce(p, 0) AS p, q FROM own_classes JOIN ref_classes USING (lang, k)) GROUP BY doc_id
), own_words AS (
  SELECT doc_id, lang, word, count(*) AS n FROM (SELECT doc_id, lang, unnest(words) AS word FROM d) GROUP BY ALL
), hit AS (
  SELECT o.doc_id, t.rank, o.n FROM own_words o JOIN tops t ON o.lang = t.lang AND o.word = t.word
), own AS (
  SELECT doc_id, rank, n FROM hit
  UNION ALL
  SELECT d.doc_id, 17, len(d.words) - coalesce(h.n, 0)
  FROM d LEFT JOIN (SELECT doc_id, sum(n) AS n FROM hit GROUP BY doc_id) h USING (doc_id)
), wd AS (
  SELECT doc_id, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                                    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS dist
  FROM (
    SELECT d.doc_id, coalesce(own.n / nullif(len(d.words), 0), 0) AS p, t.q
    FROM d JOIN tops t USING (lang) LEFT JOIN own ON own.doc_id = d.doc_id AND own.rank = t.rank
  ) GROUP BY doc_id
), all_of AS (
  SELECT c.doc_id, len(words) AS n_words, list_sum(classes) - classes[2] AS word_chars, classes[5] AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         cd.dist AS class_distance, wd.dist AS word_distance
  FROM c LEFT JOIN r USING (doc_id) JOIN cd USING (doc_id) JOIN wd USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND class_distance <= 0.25 AND word_distance <= 0.4 AS kept,
       round(class_distance, 6) + 0.0 AS class_distance, round(word_distance, 6) + 0.0 AS word_distance
FROM all_of
"""


@query("op7_quality", QUALITY_SQL)
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality(table(spark, folder, "documents"), min_words=50)
    return found.withColumns({c: rounded(c, 6) for c in ("class_distance", "word_distance")})


MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, md5('17:' || coalesce(doc_id::VARCHAR, '')) AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n
  FROM documents
), t AS (
  SELECT source, sum(n)::DOUBLE AS tokens FROM d GROUP BY source HAVING sum(n) > 0
), p AS (
  SELECT list(tokens / total) AS p FROM t, (SELECT sum(tokens) AS total FROM t)
), goal AS (
  SELECT p, -list_sum(list_transform(p, lambda x: x * ln(x))) AS h1, ln(len(p)) AS h0 FROM p
), half(step, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN bad THEN mid ELSE low END, CASE WHEN bad THEN high ELSE mid END
  FROM (
    SELECT step, low, high, mid,
           ln(z) - list_sum(list_transform(p, lambda x: pow(x, mid) * ln(pow(x, mid)))) / z > h1 + 0.5 * (h0 - h1)
           OR list_max(list_transform(p, lambda x: pow(x, mid) / x)) / list_min(list_transform(p, lambda x: pow(x, mid) / x)) > 2.0 AS bad
    FROM (
      SELECT step, low, high, (low + high) / 2 AS mid, p, h1, h0,
             list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2))) AS z
      FROM half, goal WHERE step < 50
    )
  )
), a AS (
  SELECT high AS a FROM half WHERE step = 50
), w AS (
  SELECT source, tokens, pow(tokens / (SELECT sum(tokens) FROM t), a) AS w FROM t, a
), need AS (
  SELECT source, tokens, greatest(w * (SELECT max(tokens / w) FROM w), tokens) AS need FROM w
), plan AS (
  SELECT source, floor(need / tokens)::BIGINT AS epochs, need - floor(need / tokens) * tokens AS rest FROM need
), run AS (
  SELECT d.*, epochs, rest, sum(n) OVER (PARTITION BY d.source ORDER BY key) AS upto FROM d LEFT JOIN plan USING (source)
), times AS (
  SELECT doc_id, source, key, coalesce(epochs + (upto <= rest)::BIGINT, 1) AS times FROM run
)
SELECT doc_id, source, epoch, key[1:3] AS block, md5('17:' || epoch || ':' || source || ':' || key[1:3]) || key AS mix_key
FROM (SELECT *, unnest(range(1, times + 1)) AS epoch FROM times)
"""


@query("op5_mixing", MIX_SQL)
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents")).select("doc_id", "source", "epoch", "block", "mix_key")


@query("op8_token_files")
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, folder, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return read_tokens(spark, path)


@query("op10_packing")
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_pow2(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"), with_ids=False)


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT u, v FROM shared JOIN n x ON u = x.doc_id JOIN n y ON v = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)
), reach(doc_id, least) AS (
  SELECT u, v FROM links
  UNION
  SELECT reach.doc_id, links.v FROM reach JOIN links ON links.u = reach.least
), c AS (
  SELECT doc_id, min(least) AS least FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, c.least) AS component_id,
       d.doc_id = least(d.doc_id, c.least) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


@query("op3_near", NEAR_SQL)
def op3_near(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query("op2_suffixes")
def op2_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))


@query("op4_neighbours")
def op4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op6_chunks")
def op6_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_chunks(table(spark, folder, "documents"))


@query("op9_pii")
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return find_pii(table(spark, folder, "documents"))


FILL_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), r AS (
  SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM r
), p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:n], '') AS suffix
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


@query("op11_fill_in_middle", FILL_SQL)
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    done = fill_in_middle(table(spark, folder, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id",
        *RESULTS,
        F.sha2("text", 256).alias("output_sha256"),
        F.sha2(restored("text", "form"), 256).alias("restored_sha256"),
    )


def _cluster_sql(k: int, rounds: int) -> str:
    """One pair of tables per round: all vectors assigned, all centroids moved."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (
  SELECT i, min(struct_pack(distance := distance, number := number)) AS best FROM (
    SELECT v.i, c.number, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
    FROM long v JOIN c{r} c USING (place) GROUP BY v.i, c.number
  ) GROUP BY i
)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
  SELECT a.best.number AS number, place, sum(x) AS s, count(*) AS n FROM long JOIN a{r} a USING (i) GROUP BY ALL
), c{r + 1} AS (
  SELECT c.number, c.place, coalesce(((m.s - ((m.s % m.n) + m.n) % m.n) // m.n)::BIGINT, c.x) AS x
  FROM c{r} c LEFT JOIN m{r} m USING (number, place)
)""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), long AS (
  SELECT i, unnest(w) AS x, unnest(range(64)) AS place FROM kept
), first AS (
  SELECT w, row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), w) - 1 AS number FROM kept
  QUALIFY number < {k}
), c0 AS (
  SELECT number, unnest(w) AS x, unnest(range(64)) AS place FROM first
), {", ".join(steps)}, d AS (
  SELECT best.number AS number, sum(best.distance) AS inertia FROM a{rounds} GROUP BY 1
), h AS (
  SELECT number, sha256(string_agg(x::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM c{rounds} GROUP BY number
)
SELECT vec_id, best.number::INTEGER AS cluster, best.distance AS distance, d.inertia::BIGINT AS cluster_inertia,
       (SELECT sum(inertia) FROM d)::BIGINT AS inertia, centroid_sha256
FROM kept JOIN a{rounds} a USING (i) JOIN d ON d.number = best.number JOIN h ON h.number = best.number
"""


@query("op12_centroids", _cluster_sql(k=40, rounds=5))
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    found = cluster(table(spark, folder, "embeddings"), k=40, rounds=5)
    sums = {row["cluster"]: int(row["inertia"]) for row in found.sizes().collect()}  # one row per centroid
    total = sum(sums.values())
    shown = [
        (c, n, total, ",".join(map(str, found.centroids[c]))) for c, n in sums.items()
    ]
    clusters = spark.createDataFrame(shown, "cluster int, cluster_inertia long, inertia long, numbers string")
    clusters = clusters.withColumn("centroid_sha256", F.sha2("numbers", 256)).drop("numbers")
    return found.members.join(F.broadcast(clusters), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


TOP_SQL = """
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM kept q JOIN kept c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


@query("op13_topk", TOP_SQL)
def op13_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
