"""Plain versions of the operators' contracts, and tables of odd rows."""

import re

import pandas as pd

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD_TEXTS = [
    None, "", "   \n\t ", "...", "Ünï ßtraße 日本語 テスト 😀", "a\x00b\x1cc\x85d\xa0e", "one", "two words", "x " * 30_000, "same text here now ok " * 9,
    "same text here now ok " * 9, "A.B,C a_b +1 (482) 555-7163 me@x.example.com 10.0.0.1 4845168114407329", "\n\n a\r\n", "<|endoftext|> ▁ <unk>",
]


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if text else []


def odd_documents(spark, more=()):
    texts = [*ODD_TEXTS, *more]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", None][i % 2], 0 if t is None else len(t), f"extra{i}", i) for i, t in enumerate(texts)]
    rows += [(None, "row without an id", None, None, 3, "e", 0), rows[9], rows[9]]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score string, words int"
    )


def frame(df) -> pd.DataFrame:
    return df.toPandas()
