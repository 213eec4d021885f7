"""Token files of texts with strings of added tokens, and ids that need more bytes."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from marketloom.llm import queries, tokens

PATH = queries.tokenizer_file("byte_bpe_50k.json")


def test_query_gives_the_ids_of_the_plain_call(spark, tmp_path):
    texts = ["a <|endoftext|> b", "no such string", None, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "", "end"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op6_token_files"](spark, str(tmp_path)).collect()}
    t, start = Tokenizer.from_file(PATH), 0
    for i, text in enumerate(texts):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_ids_that_do_not_fit_are_an_error(spark):
    df = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    with pytest.raises(Exception, match="do not fit 1 bytes"):
        tokens.write_token_files(df, PATH, 0, tokens.new_folder(spark), width=1)
