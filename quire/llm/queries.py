"""The ``opN_*`` queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers

from . import alignment, bpe, language_id, line_dedup, media, mixing, near_dedup, packing, phrases, quality, secrets, token_files, toxicity
from .common import table


def op3_mixing(spark, sf_dir):
    return mixing.op(table(spark, sf_dir, "documents"))


def op1_quality(spark, sf_dir):
    return quality.op(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.op(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op4_language_id(spark, sf_dir):
    return language_id.op(table(spark, sf_dir, "documents"))


def op5_secrets(spark, sf_dir):
    return secrets.op(table(spark, sf_dir, "documents"))


def op6_media(spark, sf_dir):
    return media.op(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    return toxicity.op(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_files(spark, sf_dir):
    return token_files.op(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_near_dedup(spark, sf_dir):
    return near_dedup.op(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark, sf_dir):
    return line_dedup.op(table(spark, sf_dir, "documents"))


def op11_phrases(spark, sf_dir):
    return phrases.op(table(spark, sf_dir, "documents"))


def op12_alignment(spark, sf_dir):
    path = public_tokenizers.path
    return alignment.op(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))


def op13_packing(spark, sf_dir):
    return packing.op(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_mixing": op3_mixing,
    "op4_language_id": op4_language_id,
    "op5_secrets": op5_secrets,
    "op6_media": op6_media,
    "op7_toxicity": op7_toxicity,
    "op8_token_files": op8_token_files,
    "op9_near_dedup": op9_near_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_phrases": op11_phrases,
    "op12_alignment": op12_alignment,
    "op13_packing": op13_packing,
}
ORACLES = {
    "op3_mixing": mixing.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op11_phrases": phrases.ORACLE,
}
