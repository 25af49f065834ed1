from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from duck import SAME_TYPE  # noqa: E402

SAME_TYPE.update({"BOOLEAN": {"boolean"}, "HUGEINT": {"bigint"}})

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def texts(spark, sf01):
    """The documents' texts by id."""
    rows = spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


@pytest.fixture(scope="session")
def ids_of():
    """Token ids by the vocabulary's own library."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null, empty, blank, very long and repeated texts and rows, with columns named
    like those the operators use themselves."""
    long = " ".join(f"w{k % 977} v{k}." for k in range(40_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, long), (5, long), (5, long), (6, "one two"),
        (7, "ONE  two"), (None, "one two"), (None, None), (8, "Zeile é ñ 漢字 🙂 <|endoftext|> ü"),
        (9, "a b c d e f g. h i j k l m. n o p q r s.\nh i j k l m. x"),
        (9, "another text under the same id, quite another one."),
    ]
    rows = [(i, t, "en", "src", len(t or "")) for i, t in rows]
    extra = ("_id", "removed", "n", "h1", "verdict", "component", "text_key", "ids", "rep")
    df = spark.createDataFrame(rows, DOCUMENTS)
    for name in extra:
        df = df.selectExpr("*", f"'x' AS {name}")
    return df
