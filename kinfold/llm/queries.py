"""The operators as queries over the test tables, one per operator, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm import decontaminate as dc
from kinfold.llm import (
    alignment,
    conversations,
    embeddings,
    jaccard,
    line_dedup,
    packing,
    repeats,
    secrets,
    sharding,
    toxicity,
    warc,
)
from kinfold.llm.tables import read, sha256
from kinfold.llm.token_counts import TokenCounts, count_tokens
from kinfold.session import materialize, scratch_path

TOKENIZER = "byte_bpe_50k"
HELD_OUT = 2  # remainder of crc32(doc_id) by 4 that is never trained on
REJECT_AT = 0.3


def tokenizer_file(name: str = f"{TOKENIZER}.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(doc_id="doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, labels.where(remainder() != HELD_OUT))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents; low quality ones deleted, the other labelled ones revised.

    Texts are counted in one pass, as they are and with white space folded. What is joined with labels
    has counts and no texts.
    """
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality").dropDuplicates(["doc_id"])
    store = TokenCounts(spark, scratch_path(spark, "token_counts"))
    forms = F.array(
        F.struct(F.lit(False).alias("folded"), "text"),
        F.struct(F.lit(True).alias("folded"), F.regexp_replace("text", r"\s+", " ").alias("text")),
    )
    texts = docs.select("doc_id", "source", "lang", F.inline(forms))
    counted = materialize(count_tokens(texts, TOKENIZER, tokenizer_file()), "counted")

    def changes(rows: DataFrame, op: str) -> DataFrame:
        return rows.drop("folded").withColumns({"op": F.lit(op), "seq": F.lit(0)})

    plain, folded = counted.where("NOT folded"), counted.where("folded")
    store.commit("1-load", changes(plain, "insert"))
    store.commit("1-load", changes(plain, "insert"))  # repeated: does nothing
    low = plain.join(labels.where("quality = 0"), "doc_id", "left_semi")
    store.commit("2-low-quality", changes(low.withColumn("tokens", F.lit(0).cast("long")), "delete"))
    good = folded.join(labels.where("quality = 1"), "doc_id", "left_semi")
    store.commit("3-white-space-folded", changes(good, "revise"))
    return store.totals()


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces are packed with their token ids; digests are taken from the packed ones."""
    pieces = packing.token_pieces(read(spark, sf_dir, "documents"), tokenizer_file())
    return packing.pack(pieces).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    kept = line_dedup.kept_text(F.col("text"), F.col("keep_bitmap"))
    return lines.select("doc_id", "n_lines", "n_dropped", sha256(kept).alias("kept_sha256"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(read(spark, sf_dir, "embeddings"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(read(spark, sf_dir, "documents")).drop("row", "component")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_texts(docs, model).select(
        "doc_id",
        (remainder() == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= REJECT_AT).cast("int").alias("predicted"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.with_revisits(read(spark, sf_dir, "pages")), path)
    responses = warc.read_warc(spark, path).where("record_type = 'response'")
    revisits = warc.read_warc(spark, path, payload=False).where("record_type = 'revisit'")
    stored = responses.select(
        warc.page_number("record_id").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    referred = revisits.select(
        warc.page_number("record_id").alias("page_id"),
        F.col("payload_bytes").cast("long").alias("payload_bytes"),
        F.replace("payload_digest", F.lit("sha1:"), F.lit("")).alias("payload_digest"),
        "record_type",
        warc.page_number("refers_to").alias("refers_to"),
    )
    return stored.unionByName(referred)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    lost = repeats.remove_repeats(docs).select(
        F.col("id").alias("doc_id"), "row", "n_removed", sha256(F.col("kept")).alias("kept")
    )
    whole = repeats.plain_words(docs).select(
        "doc_id", "row", "n_words", sha256(F.col("plain")).alias("plain")
    )
    lost = lost.withColumnsRenamed({"doc_id": "_id", "row": "_row"})
    key = F.coalesce(whole["doc_id"], F.lit(repeats.NO_ID))
    joined = whole.join(lost, (key == lost["_id"]) & whole["row"].eqNullSafe(lost["_row"]), "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept", "plain").alias("kept_sha256"),
    )


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    marked = dc.decontaminate(docs, read(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        sha256(names).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents are dealt to shards; sizes and digests are taken from the dealt ones."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    return sharding.shard_rows(docs).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base span is a whole match; ``values`` lists where the secrets themselves are."""
    found = secrets.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    base = secrets.of_kind(spans, *secrets.KINDS[:3])
    counts = {
        f"n_{kind}": F.size(secrets.of_kind(spans, kind)).cast("long") for kind in secrets.KINDS[:3]
    }
    values = F.transform(
        spans,
        lambda s: F.struct(s["kind"].alias("kind"), s["value_start"].alias("start"), s["end"].alias("end")),
    )
    return found.select(
        "doc_id",
        *[c.alias(name) for name, c in counts.items()],
        sha256(secrets.listed(base)).alias("base_sha256"),
        secrets.listed(spans).alias("spans"),
        secrets.listed(values).alias("values"),
    )


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments are hashed as they come out; the texts of groups are not moved."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = alignment.align(docs, tokenizer_file(), tokenizer_file("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, sha256(F.col("groups"))).otherwise("")
    rows = aligned.withColumn("groups_sha256", digest).drop("groups")
    return alignment.with_pair_counts(rows)


def damaged_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the faults of the contract; ``fault`` 0 is a lost turn."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *name).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        "fault",
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with faults made by the contract, repaired at least cost."""
    rows = damaged_turns(read(spark, sf_dir, "conversations"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    left = rows.where("fault <> 0").select("conv_id", "turn", "role", "text", copies.alias("copy"))
    repaired = conversations.digests(conversations.repair(left.drop("copy")))
    zeros = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    lost = rows.groupBy("conv_id").agg(F.max("fault").alias("most")).where("most = 0")
    none = lost.select(
        "conv_id",
        *[F.lit(0).cast("long").alias(c) for c in zeros],
        F.lit("").alias("audit"),
        sha256(F.lit("")).alias("repaired_sha256"),
    )
    return repaired.unionByName(none)


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_best_fit_packing,
        op3_line_dedup,
        op4_embedding_near_dedup,
        op5_ngram_jaccard,
        op6_toxicity,
        op7_warc,
        op8_substring_dedup,
        op9_benchmark_decontamination,
        op10_sharding,
        op11_secret_scans,
        op12_cross_tokenizer_alignment,
        op13_conversation_repair,
    )
}

# Only this one is within reach of SQL on whole tables; the others are tested against brute force.
ORACLES = {
    "op7_warc": """
        WITH p AS (
          SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                 sha1(coalesce(html, '')) AS payload_digest
          FROM pages
        ), g AS (
          SELECT payload_digest, max(page_id) AS kept
          FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN kept <> page_id THEN kept END AS refers_to
        FROM p LEFT JOIN g USING (payload_digest)
    """,
    "op3_line_dedup": """
        WITH lines AS (
          SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
        ), keyed AS (
          SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
          FROM lines
        ), shared AS (
          SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
          GROUP BY k HAVING count(DISTINCT doc_id) >= 5
        ), marked AS (
          SELECT doc_id, pos, line, coalesce(doc_id <> keeper, false) AS gone
          FROM keyed LEFT JOIN shared USING (k)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
                 AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
}
