"""Queries of this package and the SQL that they are held against, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cladeforge.llm import chat, decontamination, language_id, licenses, packing, periodic, pieces, ppm, quality_model, quality_rules, simhash, suffix_dedup, whitening
from cladeforge.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_texts(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(table(spark, sf_dir, "documents"), piece_model_path())


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_packing, op3_license_scan, op4_language_id, op5_quality_rules, op6_lm_scoring, op7_quality_classifier, op8_chat_formatting, op9_decontamination, op10_simhash,
        op11_whitening, op12_pieces, op13_periodic_runs,
    )
}

_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9 = f"""
with i as (select cast(item_id as varchar) as item, regexp_extract_all({_FOLD}, '{_WORD}') as w from benchmark),
iw as (select distinct item, w[s:s + 9] as win from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from i where len(w) > 0)),
sizes as (select distinct len(win) as n from iw),
d as (select row_number() over () as r, doc_id, regexp_extract_all({_FOLD}, '{_WORD}') as w from documents),
dw as (select r, s, n, w[s:s + n - 1] as win from (select r, w, n, unnest(range(1, len(w) - n + 2)) as s from d, sizes where len(w) >= n)),
m as (select r, s, n, item from dw join iw using (win)),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from (select distinct r, s, n from m)) group by r),
it as (select r, count(*) as n_items, string_agg(item, ',' order by item collate "C") as items from (select distinct r, item from m) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join it using (r)""".replace(' collate "C"', "")

ORACLES: dict[str, str] = {"op3_license_scan": licenses.oracle(), "op5_quality_rules": quality_rules.oracle(), "op8_chat_formatting": chat.ORACLE, "op9_decontamination": OP9}
