import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradeloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "The quick brown fox's 12 jumps, and they'll go on.\n\n  Twice\t\tover  ",
    "Grüße aus Köln, ça va? el niño ñandú 日本語テキスト 🎉🎉 x́",
    "a <|endoftext|><|endoftext|> b<|endoftext|>",
    " \x1c\x1d \x85\xa0　 \r\n ՘ \U0003d000",
    "ab" * 3000 + " " + "q" * 70 + " <|endoftext|",
    "",
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


def lexicon_of(vocabulary, texts):
    words = sorted({w.encode() for t in texts for w in bpe.words(t)})
    return bpe.compile_lexicon((w, vocabulary.merge(w)) for w in words if len(w) <= bpe.LEXICON_BYTES)


def test_ids_are_those_of_the_library(spark, vocabulary):
    rows = [(i, t, "clash") for i, t in enumerate([*TEXTS, None, TEXTS[0]])] + [(0, TEXTS[0], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    lexicon = bpe.train_lexicon(docs, vocabulary)
    library = Tokenizer.from_file(PATH)
    for r in bpe.encode(docs, vocabulary, lexicon).collect():
        text = rows[r.doc_id][1] or ""
        want = library.encode(text, add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    digests = {(r.doc_id, r.ids_sha256) for r in bpe.encode(docs, vocabulary, lexicon, digests=True).collect()}
    assert len(digests) == len(rows) - 1  # the repeated row gives an equal one


def test_merging_together_is_merging_one_by_one(vocabulary):
    rng = random.Random(3)
    words = ["".join(rng.choice("aeintho  sr1.é") for _ in range(rng.randint(0, 70))).encode() for _ in range(400)]
    assert [np.frombuffer(m, "<u4").tolist() for m in vocabulary.merge_many(words)] == [vocabulary.merge(w) for w in words]


def test_lexicon_shares_suffixes_and_finds_only_its_words(vocabulary):
    words = sorted(a + b for a in (b"walk", b"talk", b"jump", b"") for b in (b"", b"s", b"ed", b"ing") if a + b)
    lexicon = bpe.Lexicon(bpe.compile_lexicon((w, [i]) for i, w in enumerate(words)))
    assert len(lexicon.final) < 20  # a trie has more than thirty states
    assert lexicon.find(words).tolist() == list(range(len(words)))
    assert lexicon.find([b"", b"wal", b"walker", b"ings", b"\xff"]).tolist() == [-1] * 5
    with pytest.raises(ValueError):
        bpe.compile_lexicon([(b"b", [1]), (b"a", [2])])


def test_empty_table_and_empty_lexicon(spark, vocabulary):
    docs = spark.createDataFrame([], "doc_id long, text string")
    lexicon = bpe.train_lexicon(docs, vocabulary)
    assert bpe.encode(docs, vocabulary, lexicon).count() == 0
    one = bpe.Encoder(vocabulary, lexicon).encode(["never seen"])[0]
    assert np.frombuffer(one, "<u4").tolist() == Tokenizer.from_file(PATH).encode("never seen").ids
