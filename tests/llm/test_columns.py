"""Every operator beside columns whose names differ by case, and with dots in names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.llm import (collocations, decontaminate, licenses, merkle, permutation_index, pii, quality, sentence_pieces, sentence_spans, simhash,
                           suffix_dedup, token_files, toxicity)
from tests.llm.test_texts import PROSE

SCHEMA = "Doc_Id string, doc_id long, TEXT long, text string, Lang int, lang string, LANG string, source string, n_chars long, N_CHARS string"


def docs(spark):
    return spark.createDataFrame([("x", i, i, t, 1, "en", "y", "s", len(t), "z") for i, t in enumerate([*PROSE, PROSE[0]])], SCHEMA)


def plain(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate([*PROSE, PROSE[0]])], "doc_id long, text string, lang string, source string, n_chars long")


def token_rows(spark, df, tmp):
    import public_tokenizers
    token_files.write(df, tmp, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return token_files.read(spark, tmp, tokens=False)


def labels(spark, clash):
    rows = [(i, "l", i % 2, "m") for i in range(len(PROSE))]
    return spark.createDataFrame(rows, "doc_id long, Doc_ID string, toxic int, Toxic string" if clash else "doc_id long, other string, toxic int, more string")


def pieces(spark, df):
    import public_tokenizers
    return sentence_pieces.encode_decode(df, public_tokenizers.path("piece_bpe_32k.model"))


OPERATORS = {
    "suffix": lambda spark, df, clash, tmp: suffix_dedup.deduplicate(df, length=60),
    "quality": lambda spark, df, clash, tmp: quality.score(df),
    "simhash": lambda spark, df, clash, tmp: simhash.near_duplicates(df),
    "licenses": lambda spark, df, clash, tmp: licenses.scan(df),
    "toxicity": lambda spark, df, clash, tmp: toxicity.score(df, labels(spark, clash)),
    "decontaminate": lambda spark, df, clash, tmp: decontaminate.find_contamination(df, spark.createDataFrame(
        [("q", 1, "u", PROSE[0])], "Item_ID string, item_id int, TEXT string, text string" if clash else "a string, item_id int, b string, text string")),
    "spans": lambda spark, df, clash, tmp: sentence_spans.deduplicate(df, carry=["source"]),
    "pieces": lambda spark, df, clash, tmp: pieces(spark, df),
    "pii": lambda spark, df, clash, tmp: pii.find_pii(df),
    "tokens": lambda spark, df, clash, tmp: token_rows(spark, df, tmp),
    "merkle": lambda spark, df, clash, tmp: merkle.manifest(df),
    "collocations": lambda spark, df, clash, tmp: collocations.collocations(df, min_count=3),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_case_variants_do_not_clash(spark, tmp_path, name):
    both = []
    for clash, make in ((True, docs), (False, plain)):
        df = OPERATORS[name](spark, make(spark), clash, str(tmp_path / f"out{clash}"))
        both.append(sorted((str(r) for r in df.collect())))
    assert both[0] == both[1] and both[0]


def test_vectors_with_case_variants(spark):
    x = np.random.default_rng(3).normal(size=(60, 8)).tolist()
    df = spark.createDataFrame([("a", i, 0, v) for i, v in enumerate(x)], "VEC_ID string, vec_id long, Embedding int, embedding array<double>")
    got = permutation_index.search(df, lambda i: i % 20 == 0, k=3)
    assert got.count() == 9
