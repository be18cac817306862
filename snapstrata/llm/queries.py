"""One query per operator over the given tables, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.llm import (
    chat, decontam, langid, maxent, mixing, neardup, pivots, quality, repair, secrets, tokenfile,
    toxicity, whitening,
)
from snapstrata.llm.common import id_bucket, stored, table
from snapstrata.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def tokenizer_path() -> str:
    """The public byte-level vocabulary; tasks read it where they run."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_quality")
def op1_quality(spark, sf_dir):
    """Quality of every document; a third of the ids is held out of the fit."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 3) == 1
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = quality.with_quality(docs, model, ["doc_id"], "score")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_secrets")
def op2_secrets(spark, sf_dir):
    """Key patterns and high-entropy strings in every document."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("secret_spans", lambda s: s["rank"] < len(secrets.KINDS))
    kinds = F.transform("secret_spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in secrets.KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("secret_spans")).alias("spans"),
    )


@query("op3_near_duplicates")
def op3_near_duplicates(spark, sf_dir):
    """The class of near-duplicates that each document belongs to."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_decontamination")
def op4_decontamination(spark, sf_dir):
    """Documents that hold passages of the benchmark, and where."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_token_ids")
def op5_token_ids(spark, sf_dir):
    """Ids of every document, written as coded files and read back."""
    path = scratch_dir(spark, "token-files")
    tokenfile.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return tokenfile.id_checksums(tokenfile.read_token_files(spark, path))


@query(
    "op6_mixture",
    r"""
    WITH sized AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
    ), by_source AS (
      SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
    ), weighed AS (
      SELECT *, 2.0::DOUBLE * source_size AS cap,
        [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
      FROM by_source
    ), candidates AS (
      SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS candidate
      FROM weighed WINDOW before AS (
        ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), targets AS (
      SELECT source, source_size, least(cap, coalesce(
        max(CASE WHEN candidate * weight <= cap THEN candidate END) OVER () * weight, cap)) AS target
      FROM candidates
    ), placed AS (
      SELECT doc_id, size, source, floor(target + 1e-6)::BIGINT AS goal,
        sum(size) OVER (PARTITION BY source ORDER BY pass, md5(doc_id || ':' || pass || ':0'), doc_id) - size AS begins
      FROM sized JOIN targets USING (source), (VALUES (0), (1)) AS passes(pass)
    ), mixed AS (
      SELECT doc_id, sum(greatest(0, least(begins + size, goal) - begins))::BIGINT AS taken
      FROM placed GROUP BY doc_id
    )
    SELECT doc_id, size::BIGINT AS size, source_size, target, taken
    FROM sized JOIN targets USING (source) JOIN mixed USING (doc_id)
    """,
)
def op6_mixture(spark, sf_dir):
    """What a mix of all documents takes of each."""
    sizes, targets, mixture = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixing.taken_words(sizes, targets, mixture).drop("row")


EXTRA_TURN = "</s>[INST] ok [/INST]"


@query(
    "op7_chat",
    rf"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '{EXTRA_TURN}' UNION ALL SELECT -1, 1, 'assistant', '{EXTRA_TURN}'
    ), marked AS (
      SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) <> role, TRUE) AS opens,
        len(text) + len(regexp_extract_all(text, '<\\*(\||/?s>)')) + len(regexp_extract_all(text, '\[\\*/?INST\]')) AS n_text,
        len(role) + len(regexp_extract_all(role, '<\\*(\||/?s>)')) + len(regexp_extract_all(role, '\[\\*/?INST\]')) AS n_role
      FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      sum(n_text + CASE WHEN opens THEN n_role + {len(chat.ROLE + chat.TEXT + chat.END)} ELSE {len(chat.NEXT)} END)::BIGINT
        AS formatted_chars
    FROM marked GROUP BY conv_id
    """,
)
def op7_chat(spark, sf_dir):
    """Every conversation formatted, written, and read back from the written text."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.explode(F.array(*(F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))))).alias("t"),
    ).select("conv_id", "t.turn", "t.role", F.lit(EXTRA_TURN).alias("text"))
    output = stored(chat.format_conversations(turns.unionByName(extra)), "chat")
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    back = chat.parse_formatted(output, "loss_spans").withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(each, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query("op8_language")
def op8_language(spark, sf_dir):
    """The language of every document; a quarter of the ids is held out of the profiles."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 4) == 2
    profiles = langid.language_profiles(docs, ~held_out)
    found = langid.with_language(docs, profiles, ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op9_lm_scores")
def op9_lm_scores(spark, sf_dir):
    """Log10 probability of every document; a fifth of the ids is held out of training."""
    docs = table(spark, sf_dir, "documents")
    return maxent.lm_scores(docs, id_bucket(F.col("doc_id"), 5) != 1)


@query(
    "op10_top_k",
    """
    WITH whole AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    ), ranked AS (
      SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
      FROM scored
    )
    SELECT * FROM ranked WHERE rank <= 5
    """,
)
def op10_top_k(spark, sf_dir):
    """The five nearest vectors of each query by inner product."""
    rows = table(spark, sf_dir, "embeddings")
    vectors = rows.select("vec_id", pivots.quantized(F.col("embedding")).alias("v"))
    return pivots.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


@query("op11_toxicity")
def op11_toxicity(spark, sf_dir):
    """Toxicity of every document; a fifth of the ids is held out of the fit."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 5) == 0
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.with_toxicity(docs, model, ["doc_id"], "score")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op12_structure_repair")
def op12_structure_repair(spark, sf_dir):
    """Cheapest audit of every damaged conversation, and the digest of what it leaves."""
    rows = repair.damaged(table(spark, sf_dir, "conversations"))
    repaired = repair.repair_conversations(rows, F.col("present"))
    digests = repair.repaired_digests(repaired.lines).select(F.col("conv_id").alias("of"), F.col("digest").alias("repaired_sha256"))
    return repaired.audits.join(digests, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    """Every valid embedding projected on the eight leading components, each of unit deviation."""
    rows = table(spark, sf_dir, "embeddings")
    return whitening.whitened_components(rows, whitening.fit_whitening(rows), "embedding", "vec_id")
