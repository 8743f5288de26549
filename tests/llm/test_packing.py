import collections
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quotewell.llm import packing
from tests.llm.samples import docs_of, odd_texts, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected_ids(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def test_every_id_lies_in_one_piece_and_windows_are_full(spark):
    rows = odd_texts()
    out = packing.piece_digest(packing.pack(docs_of(spark, rows).coalesce(1), PATH)).toPandas()
    by_doc = collections.Counter((i if i is not None else -1, len(expected_ids(t))) for i, t in rows)
    seen = collections.Counter()
    for (i, n), part in out.assign(doc_id=out.doc_id.fillna(-1)).groupby(["doc_id", "doc_tokens"]):
        assert part.length.sum() == n * by_doc[(i, n)]
        seen[(i, n)] = by_doc[(i, n)]
    assert seen == by_doc
    for _, window in out.groupby("sequence_id"):
        window = window.sort_values("offset")
        assert list(window.offset) == [0, *np.cumsum(window.length)[:-1]]
        total = window.length.sum()
        assert total <= 2048 and total & (total - 1) == 0  # no padding at all
    for _, group in out.groupby("step_group"):
        assert group.length.sum() <= 32_768


def test_ids_are_those_of_the_tokenizer(spark):
    rows = [(k, t) for k, (_, t) in enumerate(odd_texts())]
    texts = dict(rows)
    for r in packing.pack(docs_of(spark, rows), PATH).collect():
        want = np.array(expected_ids(texts[r["doc_id"]])[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert bytes(r["ids"]) == want
        assert zlib.crc32(want) >= 0


def test_words_that_the_fast_path_must_not_touch():
    encode = packing.WordEncoder(PATH, cached=10).encode
    texts = ["It's a <|endoftext|> ''s Ａ ½ ﬁ İstanbul क़x. ≮ a.'s x---y 中文,字 a\x1cb c\x85 don't µm ª ÿĮ", " ́a .́ a,́", prose(7, 50), ""]
    for text, ids in zip(texts * 2, encode(texts) + encode(texts)):
        assert list(np.frombuffer(ids, "<u4")) == expected_ids(text)[:-1]


def test_a_word_is_tokenized_once_whatever_its_case_and_marks():
    class Counted:
        def __init__(self, model):
            self.model, self.words = model, []

        def tokenize(self, word):
            self.words.append(word)
            return self.model.tokenize(word)

    encoder = packing.WordEncoder(PATH)
    encoder.model = Counted(encoder.model)
    text = "Window window, WINDOW. window"
    assert list(np.frombuffer(encoder.encode([text, text])[1], "<u4")) == expected_ids(text)[:-1]
    assert encoder.model.words == ["window"]


def test_tiers_and_chunks():
    lengths = [5000, 1, 700, 300, 2048, 90, 2047, 1025]
    windows = packing.pack_lengths(lengths)
    got = collections.defaultdict(list)
    for window in windows:
        for doc, start, length in window:
            got[doc].append((start, length))
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(got[doc]):
            assert start == at and length > 0
            at += length
        assert at == n
    assert packing.pack_lengths([]) == []


def test_empty_table(spark):
    assert packing.pack(docs_of(spark, []), PATH).count() == 0
