import zlib

import numpy as np
from tokenizers import Tokenizer

from marketloom.llm import queries, tokens

SF = "/root/testdata/sf0.001"
PATH = queries.tokenizer_file("byte_bpe_50k.json")


def plain(rows):
    """(doc_id, start, n_tokens, crc) with every text encoded on its own, in key order."""
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_is_plain_encoding(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op6_token_files"](spark, SF).collect())
    assert got == plain(rows)


def test_odd_texts(spark):
    samples = [
        None, "", " ", "\n\n", "a  b \n c", "x  y", "  z", "\n  q", "it's we'll  'S", "tab\t tab", "é è  ñ 12 345", "　 w 　w",
        "<|endoftext|> <|endoftext|>", "🙂 🙂  🙂", "\x1c \x1d a \x85 b", "a" * 3000, " - -- ---", "\r\n \r\n x", "word " * 5000, "    v", "中 文  中",
    ]
    rows = [(i, t, None, 1, 2) for i, t in enumerate(samples)] + [(None, "null key", "x", 0, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, start int, tokens int")
    folder = tokens.new_folder(spark)
    parts = tokens.write_token_files(df, PATH, 0, folder, width=2)
    got = sorted((tuple(r) for r in tokens.crc_of_tokens(tokens.read_token_files(spark, folder, len(parts))).collect()), key=lambda r: r[1])
    assert got == plain([r[:2] for r in rows])


def test_repeated_and_no_rows(spark):
    for rows in ([(5, "same")] * 4 + [(5, "other")], []):
        folder = tokens.new_folder(spark)
        parts = tokens.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), PATH, 0, folder)
        got = tokens.read_token_files(spark, folder, len(parts)).collect()
        assert len(got) == len(rows)
        assert sorted(r.start for r in got) == [int(x) for x in np.cumsum([0] + [len(r.tokens) for r in sorted(got, key=lambda r: r.start)])[:-1]]
