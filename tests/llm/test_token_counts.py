import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lumentide.llm.token_counts import Counter, MergeTable, count_tokens, pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    r = random.Random(5)
    alphabet = list("aaabcde  \n\t'sréßñ漢字😀0123456789.,!?<|>\x00\x1c\x85\xa0　_-%") + ["<|endoftext|>", "'ll", " the", "tion"]
    yield from ["", " ", "\n\n", "aaaaaaa", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 3000, "the " * 500, " \n x", "éa"]
    for _ in range(600):
        yield "".join(r.choice(alphabet) for _ in range(r.randint(1, 80)))


def test_same_as_library(library):
    texts = list(odd_texts())
    counter = Counter(MergeTable(PATH), remembered=500)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counter.count(texts) == want
    assert [counter.count([t])[0] for t in texts[:200]] == want[:200]


def test_pieces_do_not_change_counts(library):
    text = "the quick  brown fox\n jumps 12 times " * 300
    assert "".join(pieces(text, 100)) == text
    counter = Counter(MergeTable(PATH))
    assert sum(counter.many(list(pieces(text, 100)))) == len(library.encode(text, add_special_tokens=False).ids)


def test_frame(spark, sf, library):
    rows = [(1, None, "x"), (2, "", "y"), (2, "hello world", "z"), (None, "hello world", None)]
    out = count_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), PATH).collect()
    assert sorted(map(tuple, out), key=str) == sorted([(1, 0, 0, False), (2, 0, 0, False), (2, 11, 2, False), (None, 11, 2, False)], key=str)
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in count_tokens(docs, PATH).collect()} == want
