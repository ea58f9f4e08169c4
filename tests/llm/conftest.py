from __future__ import annotations

import pytest

#: Texts that every operator must stand: null, empty, blank, tiny, huge, odd characters.
ODD = [None, "", " ", "\n\n", "a", "é", "word", "two words", "  spaced   out  ", "tab\tand\nnewline\r\n", "日本語 テキスト 。", "<|endoftext|> text", "0", "%%% ###", "x" * 5000, "ab " * 4000, "\U0001f600 smile \x1c odd"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, repeated rows, a null id, and columns whose names could clash."""
    rows = [(i, t, "en", "s", 1, "x", 0) for i, t in enumerate(ODD)] + [(None, "no id here at all", "fr", None, None, None, None), (3, ODD[3], None, "s", 2, "y", 1), (8, "another text of the same id", "de", "s", 2, "z", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, seq int, spans string, n int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def tokenizer():
    from strandlake.llm.queries import tokenizer_path

    return tokenizer_path()
