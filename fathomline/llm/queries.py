"""The registered queries: one ``opN_<name>`` for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.llm import (bpe, decontaminate, fill_in_middle, language_id, mixing, quality_mil, quality_rules, sharding, simhash, sql_parts, suffix_repeats, toxicity,
                            url_rules, whitening)
from fathomline.llm.registry import query

# Relative weights of sources in the mixture; a source not named has weight 1.
SOURCE_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}
SEED = 42
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query(sql_parts.QUALITY_RULES)
def op1_quality_rules(t):
    return quality_rules.quality_rules(t.documents, t.labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op2_suffix_repeats(t):
    made = suffix_repeats.without_repeats(t.documents)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return made.select(
        "doc_id", (F.octet_length("kept") + removed).cast("bigint").alias("n_bytes"), removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op3_toxicity(t):
    return toxicity.toxicity(t.documents, t.labels)


@query(sql_parts.DECONTAMINATION)
def op4_decontamination(t):
    return decontaminate.contained_items(t.documents, t.benchmark)


@query()
def op5_simhash_components(t):
    made = simhash.simhash_components(t.documents)
    return made.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query(sql_parts.URL_RULES)
def op6_url_rules(t):
    judged = url_rules.judged_urls(t.pages.select("page_id", "url"), url_rules.rule_rows(t.spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query(sql_parts.mixing_sql(SOURCE_WEIGHTS, 1.0, SEED))
def op7_source_mixing(t):
    copies = mixing.mixed(t.documents, SOURCE_WEIGHTS, 1.0, SEED)
    return copies.select("doc_id", "source", F.round("rate", 9).alias("rate"), "copy", "order_key", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))


@query()
def op8_language_id(t):
    return language_id.identified(t.documents)


@query()
def op9_sharding(t):
    placed = sharding.sharded(t.documents.select("doc_id", "text"))
    return placed.select(
        "doc_id", sharding.record_bytes(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query()
def op10_quality_mil(t):
    return quality_mil.quality_scores(t.documents, t.labels)


@query()
def op11_bpe(t):
    import public_tokenizers  # names the folder of the vocabulary files; only this query needs it

    definition = bpe.read_definition(public_tokenizers.path("byte_bpe_50k.json"))
    made = bpe.decoded(bpe.encoded(t.documents.select("doc_id", "text"), definition), definition)
    return made.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query(sql_parts.FILL_IN_MIDDLE)
def op12_fill_in_middle(t):
    made = fill_in_middle.restored(fill_in_middle.transformed(t.documents.select("doc_id", "text")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


@query()
def op13_whitening(t):
    return whitening.long_form(whitening.whitened(t.embeddings.select("vec_id", "embedding"), "embedding"))
