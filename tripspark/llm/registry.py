"""Queries of the thirteen text operators: each applies its operator to the whole of
its table and derives the contract's columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_run_length_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.repeat_removal import remove_repeats

    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op2_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.compression_quality import fit, score_quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model, ("doc_id",)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_stateful_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.stateful_dedup import stateful_dedup

    return stateful_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_parity_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.parity_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.source_mixing import assign

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return assign(docs).select("doc_id", "size", "source_size", "target",
                               (F.col("size") * F.size("draws")).cast("long").alias("taken"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_word_table_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.word_bpe import encode_words

    return encode_words(table(spark, sf_dir, "documents"), tokenizer_path()).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_projection_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.projection_neighbors import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_assignment_lexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.secret_scan import BASE_KINDS, find_secrets

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", *[count(k) for k in BASE_KINDS],
        F.sha2(written(F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"))


CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op9_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.chat_format import expand, read_back

    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-7).cast(talks.schema["conv_id"].dataType).alias("conv_id"),
                                F.col("id").cast(talks.schema["turn"].dataType).alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit(CONTROL_TEXT).alias("text"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(expand(talks.unionByName(own))).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def op10_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.language_id import fit, identify

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_lexicon_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.toxicity import fit, held_out, score_toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, ("doc_id",)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op12_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.lexical_search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripspark.llm.filter_audit import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_oracle() -> str:
    """Groups of equal normalised texts in DuckDB."""
    return r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)"""


def op4_oracle() -> str:
    """Shingle sets, their overlaps and the transitive closure of the links in DuckDB."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [hash(array_to_string(w, ' '))]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' '))))
                 END AS s
  FROM t
), e AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS h FROM g
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id, doc_id AS x FROM documents
  UNION
  SELECT r.doc_id, l.b FROM r JOIN l ON r.x = l.a
)
SELECT g.doc_id, CAST(len(g.s) AS BIGINT) AS n_shingles, min(r.x) AS component_id
FROM g JOIN r USING (doc_id) GROUP BY g.doc_id, len(g.s)"""


def op9_oracle() -> str:
    """The same conversations in DuckDB; the written length of a turn follows from its escapes."""
    return r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), w AS (
  SELECT *, 13 + length(role) + length(regexp_replace(role, '[^\\#<\n]', '', 'g'))
            + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS n,
         row_number() OVER o AS place, max(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (
           PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), c AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM w
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(coalesce(sum(upto) FILTER (WHERE role = 'assistant'), 0) + coalesce(sum(n) FILTER (WHERE used = 0), 0) AS BIGINT)
         AS formatted_chars
FROM c GROUP BY conv_id"""


def op12_oracle() -> str:
    """Scores of all documents for all items, by term, in DuckDB."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def words(column: str) -> str:
        return rf"regexp_extract_all(translate(coalesce({column}, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

    return rf"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS r, {words("text")} AS words FROM documents
), q AS (
  SELECT item_id, i, term, count(*) AS times FROM (
    SELECT item_id, i, unnest(words) AS term FROM (
      SELECT item_id, row_number() OVER () AS i, {words("text")} AS words FROM benchmark))
  GROUP BY item_id, i, term
), c AS (
  SELECT count(*) FILTER (WHERE len(words) > 0) AS n_all, CAST(sum(len(words)) AS BIGINT) AS length_all FROM t
), p AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM t)
  WHERE term IN (SELECT term FROM q) GROUP BY r, term
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_all + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM p, c GROUP BY term, n_all
), m AS (
  SELECT r, doc_id, 75 + (25 * len(words) * n_all) // length_all AS m FROM t, c WHERE len(words) > 0
), s AS (
  SELECT item_id, i, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY item_id, i, r, doc_id
), k AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20"""


def op13_oracle() -> str:
    """The filters applied in all 120 orders, and sums over the orders, in DuckDB."""
    return r"""
WITH l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents
), g AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
            100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 3 * length(x),
            regexp_matches(x, '[#$%&*|]'), coalesce(doc_id > least, false)] AS fails
    FROM t LEFT JOIN l USING (doc_id))
  GROUP BY part, fails
), o AS (
  SELECT [a.i, b.i, c.i, d.i, 15 - a.i - b.i - c.i - d.i] AS o
  FROM range(1, 6) a(i), range(1, 6) b(i), range(1, 6) c(i), range(1, 6) d(i)
  WHERE len(list_distinct([a.i, b.i, c.i, d.i])) = 4
), e AS (
  SELECT part, o, s.i AS step, o[s.i] AS f, n, good, toxic, fails[o[s.i]] AS bad,
         list_bool_or(list_concat([false], list_transform(o[1:s.i - 1], lambda j: fails[j]))) AS gone,
         len(list_filter(fails, lambda b: b)) AS failed
  FROM g, o, range(1, 6) s(i)
), r AS (
  SELECT part, o, step, f, coalesce(sum(n) FILTER (WHERE NOT gone AND NOT bad), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE NOT gone AND bad), 0) AS removed, coalesce(sum(n) FILTER (WHERE gone AND bad), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE bad AND failed = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE NOT gone AND bad), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE NOT gone AND bad), 0) AS toxic_lost
  FROM e GROUP BY part, o, step, f
)
SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, CAST(step AS INTEGER) AS step,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r"""


def queries() -> dict[str, Query]:
    import corpus_pipeline

    return {
        "op1_run_length_repeats": op1_run_length_repeats,
        "op2_compression_quality": op2_compression_quality,
        "op3_stateful_dedup": op3_stateful_dedup,
        "op4_parity_jaccard": op4_parity_jaccard,
        "op5_projection_passes": op5_projection_passes,
        "op6_source_mixing": op6_source_mixing,
        "op7_assignment_lexing": op7_assignment_lexing,
        "op8_word_table_bpe": op8_word_table_bpe,
        "op9_prefix_targets": op9_prefix_targets,
        "op10_cross_parsing": op10_cross_parsing,
        "op11_lexicon_automata": op11_lexicon_automata,
        "op12_best_position": op12_best_position,
        "op13_filter_audit": op13_filter_audit,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_stateful_dedup": op3_oracle(), "op4_parity_jaccard": op4_oracle(), "op9_prefix_targets": op9_oracle(),
            "op12_best_position": op12_oracle(), "op13_filter_audit": op13_oracle()}
