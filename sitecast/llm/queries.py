"""The queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.llm import chat, decontam, html_text, langid, lines, mixing, ngram_join, oracles, pii, prefix_trie, quality, spelling, tokens, warc
from sitecast.llm.tables import table
from sitecast.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op2_ngram_jaccard": oracles.NGRAM_JACCARD,
    "op3_line_windows": oracles.LINE_WINDOWS,
    "op4_mix_sources": oracles.MIX_SOURCES,
    "op7_spaced_seeds": oracles.SPACED_SEEDS,
    "op11_chat_template": oracles.CHAT_TEMPLATE,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    """The public tokenizer of the token contract."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_pii_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document; the counts are of the base spans, ``spans`` lists all."""
    docs = table(spark, sf_dir, "documents")
    return pii.base_counts(pii.find_personal_data(docs, pii.train_tagger(docs))).drop("base_spans")


@query
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle-set size and component of every document."""
    out = ngram_join.jaccard_classes(table(spark, sf_dir, "documents"))
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


@query
def op3_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed from every document, and a digest of what is left."""
    out = lines.dedupe_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"), F.sha2("text", 256).alias("text_sha256"))


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    out = mixing.mix(table(spark, sf_dir, "documents"), mixing.quality_weights(table(spark, sf_dir, "labels")))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query
def op5_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    return tokens.checksums(tokens.through_files(table(spark, sf_dir, "documents"), tokenizer_path()))


@query
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.main_text(table(spark, sf_dir, "pages"))


@query
def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    out = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "n_match", "n_window")


@query
def op8_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality figures and verdict of every document."""
    out = quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.drop("text")


@query
def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits in a crawl of the pages, and the responses they stand for."""
    raw = warc.captures(table(spark, sf_dir, "pages"))
    return warc.resolve_revisits(warc.parse_records(raw))


@query
def op10_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2
    out = langid.predict(docs, langid.train(docs.where(~held)))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


@query
def op11_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one with control strings in its texts, formatted, stored and read back."""
    text = oracles.CHAT_EXTRA_TEXT
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat.read_back(materialize(chat.format_conversations(rows)))
    per_turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(per_turn, ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
        "valid",
    )


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words of every counted word of the documents, its form and its root."""
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.trie(prefix_trie.rebuild(table(spark, sf_dir, "conversations")))
