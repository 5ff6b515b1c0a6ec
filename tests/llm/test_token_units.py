"""Units of plain letters are counted by the model once per word, others by the library."""

import random

import public_tokenizers
import pyarrow as pa
import pytest

from seriesloom.llm import token_counts

FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "Plain words, more words. words words; wordsé ßtraße!", "", " ", "\n\n x", "<|endoftext|> hi<|endoftext|>", "don't It's ,.,  a", "x²  ½. Ⅷ,", "ÀÉ×÷ ǃ. ée", "a b words",
    "​ x", "a\x0bb", "  two  spaces ", "tab\tword, 'tis !!! ...?!", "日本 語, кот.", "x y. z", "1st 2nd,3",
]


class Watched:
    """The tokenizer, noting what the model and the library are asked."""

    def __init__(self, tokenizer):
        self.tokenizer, self.words, self.units = tokenizer, [], []

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    @property
    def model(self):
        return self

    def tokenize(self, word):
        self.words.append(word)
        return self.tokenizer.model.tokenize(word)

    def encode_batch_fast(self, units, **kw):
        self.units += units
        return self.tokenizer.encode_batch_fast(units, **kw)


@pytest.mark.parametrize("remembered", [1_000_000, 3])
def test_as_the_library(remembered):
    plain = token_counts.load(FILE)
    counter, want = token_counts.Counter(plain, remembered=remembered), [len(plain.encode(t, add_special_tokens=False)) for t in TEXTS]
    assert counter.count(TEXTS) == want
    assert [counter.count([t])[0] for t in TEXTS] == want
    assert counter.count(TEXTS[::-1]) == want[::-1]


def test_words_are_asked_once():
    watched = Watched(token_counts.load(FILE))
    counter = token_counts.Counter(watched)
    counter.count(["one two, two. two one", " one; two,"])
    counter.count(["one two two"])
    assert sorted(watched.words) == ["one", "Ġone", "Ġtwo"] and not watched.units
    counter.count(["one don't don't"])
    assert watched.units == [" don't"]


def test_a_split_that_is_not_known():
    from tokenizers import pre_tokenizers

    plain = token_counts.load(FILE)
    plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    assert not token_counts.Counter(plain).plain


def test_a_word_is_remembered_without_its_marks():
    watched = Watched(token_counts.load(FILE))
    counter = token_counts.Counter(watched)
    text = "two, two. (two two; two é, é É. É"
    assert counter.count([text]) == [len(watched.tokenizer.encode(text, add_special_tokens=False))]
    assert set(counter.known) == {"two", " two", " (two", " é", " É", ",", ".", ";"}
    assert watched.units == [" (two"]


def test_parts_of_arrays_as_the_library():
    plain, rng = token_counts.load(FILE), random.Random(3)
    signs = [*"aZéßɏɐ×÷ªƀ.,;:!?'1²-", " ", " ", "\n", "\t", "  ", "'s", "'ll.", "...", "中", "́", "\U0001f600", "\xa0", "​", "<|endoftext|>", "word", " word"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3_000)] + [None, "", None]
    want = [len(plain.encode(t or "", add_special_tokens=False)) for t in texts]
    for kind in (pa.string(), pa.large_string()):
        array, counter = pa.array(texts, kind), token_counts.Counter(plain, chunk=30, overlap=5)
        assert [n for at in range(0, len(texts), 7) for n in counter.counts(array.slice(at, 7))] == want
    assert token_counts.Counter(plain).counts(pa.array([], pa.string())).tolist() == []
    assert token_counts.Counter(plain).counts(pa.array([None, ""])).tolist() == [0, 0]


def test_added_tokens_of_letters_and_marks():
    for added in ("a.b", "<x.>", "word", " two."):
        plain = token_counts.load(FILE)
        plain.add_tokens([added])
        texts = [f"see {added} and{added}, word two. a.b <x.>", "word"]
        assert token_counts.Counter(plain).count(texts) == [len(plain.encode(t, add_special_tokens=False)) for t in texts]


def test_counts_of_chunks_read_no_offsets():
    class Chunk:
        def __init__(self, found):
            self.found = found

        def __getattr__(self, name):
            assert name != "offsets"
            return getattr(self.found, name)

        def __len__(self):
            return len(self.found)

    class Chunked(Watched):
        def encode(self, text, **kw):
            return Chunk(self.tokenizer.encode(text, **kw))

    plain = token_counts.load(FILE)
    text = "Words of some length, and\nmore of them. " * 50
    assert token_counts.Counter(Chunked(plain), chunk=200, overlap=20).count([text]) == [len(plain.encode(text, add_special_tokens=False))]
