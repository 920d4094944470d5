"""Driver queries of this subpackage, by problem."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.common import table
from quirelake.llm import languages, mixture, residue, scan_noise, splitting, subjects, tokens, truncation


def _records(spark: SparkSession, d: str, name: str, id_col: str, text_col: str, *more: str) -> DataFrame:
    return table(spark, d, name).select(F.lit(name).alias("source_table"), F.col(id_col).alias("row_id"), F.col(text_col).alias("body"), *more)


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    tables = (("documents", "doc_id", "text"), ("segments", "segment_id", "content"), ("page_extractions", "page_id", "text"))
    out = None
    for name, id_col, text_col in tables:
        rows = _records(spark, d, name, id_col, text_col, F.col("lang").alias("label"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _network(spark: SparkSession, d: str):
    samples = table(spark, d, "language_samples").select("lang", "text").unionByName(table(spark, d, "subject_examples").select("lang", "text"))
    return languages.fit(samples, table(spark, d, "documents"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.wrong_labels(_labelled(spark, d), *_network(spark, d))


def p1_languages(spark: SparkSession, d: str) -> DataFrame:
    return languages.label_languages(_labelled(spark, d), *_network(spark, d))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pieces = splitting.split_chunks(table(spark, d, "chunks"), table(spark, d, "split_limits"))
    return pieces.where("n_pieces > 1 AND piece_no = 0").select("chunk_row_id")


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_chunks(table(spark, d, "chunks"), table(spark, d, "split_limits"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(spark, d, "chunks")
    return splitting.regroup(chunks, splitting.split_chunks(chunks, table(spark, d, "split_limits"))).drop("content")


def _described(spark: SparkSession, d: str) -> DataFrame:
    visuals = _records(spark, d, "visuals", "visual_id", "vlm_description", "model_used")
    return visuals.unionByName(_records(spark, d, "analysis_results", "analysis_id", "description", "model_used"))


def _background(spark: SparkSession, d: str) -> DataFrame:
    """Clean texts, the same few at every scale."""
    return table(spark, d, "language_samples").select(F.col("text").alias("body")).unionByName(table(spark, d, "subject_examples").select(F.col("text").alias("body")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated_records(residue.without_residue(_described(spark, d), background=_background(spark, d)))


def p4_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_rates(residue.without_residue(_described(spark, d), background=_background(spark, d)))


def _pages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    pages = _records(spark, d, "page_extractions", "page_id", "text", "document_id", "page_number")
    scanned = pages.unionByName(_records(spark, d, "segments", "segment_id", "content", "document_id", "page_number"))
    return scanned, table(spark, d, "documents").select(F.col("text").alias("body"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise.found_noise(*_pages(spark, d))


def p5_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise.repaired_paragraphs(*_pages(spark, d))


def _messages(spark: SparkSession, d: str) -> DataFrame:
    visuals = _records(spark, d, "visuals", "visual_id", "vlm_description")
    return visuals.unionByName(_records(spark, d, "parse_results", "result_id", "error_message"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue_records(_messages(spark, d), background=_background(spark, d))


def p6_kept(spark: SparkSession, d: str) -> DataFrame:
    return residue.without_residue(_messages(spark, d), background=_background(spark, d))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    cut = subjects.cut_sentences(table(spark, d, "documents"))
    return subjects.document_subjects(cut, subjects.mine_rules(table(spark, d, "subject_examples"), cut))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _subjects(spark, d).select("doc_id", "subject")


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    return subjects.composition(_subjects(spark, d), table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (p1_found, p1_languages, p2_found, p2_pieces, p2_groups, p4_found, p4_rates, p5_found, p5_paragraphs, p6_found, p6_kept, p7_ids, p8_mix, p8_shares, p9_found, p9_composition)
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": r"""
            SELECT chunk_row_id FROM chunks JOIN split_limits USING (chunk_type)
            WHERE CASE WHEN size_unit = 'words' THEN len(list_filter(regexp_split_to_array(content, '[ \t\r\n]+'), lambda w: w <> ''))
                       ELSE length(content) END > max_size
        """,
    }
