"""How much of a corpus the tokenizers library is given to encode."""

import random
from types import SimpleNamespace

import pyarrow as pa
import pytest

pytest.importorskip("tamiz.llm")
pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer, models, pre_tokenizers  # noqa: E402

from tamiz.llm import token_counts, token_shards as ts  # noqa: E402
from tamiz.llm.queries import BYTE_BPE  # noqa: E402


class Watched:
    """A tokenizer that notes how many characters it gets, and how many of them by texts."""

    def __init__(self, tokenizer):
        self._tokenizer, self.chars, self.by_texts = tokenizer, 0, 0
        self.model = SimpleNamespace(tokenize=self.tokenize)

    def tokenize(self, word):
        self.chars += len(word)
        return self._tokenizer.model.tokenize(word)

    def encode_batch_fast(self, texts, **options):
        self.chars += sum(map(len, texts))
        self.by_texts += sum(map(len, texts))
        return self._tokenizer.encode_batch_fast(texts, **options)


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("aeinstéÜñß", k=rng.randint(2, 12))) for _ in range(300)]
    signs = ["", "", "", ",", ".", "'s", "!!"]
    return [" ".join(rng.choice(words) + rng.choice(signs) for _ in range(200)) for _ in range(60)]


def test_token_counts_give_the_library_each_word_once(monkeypatch):
    with open(BYTE_BPE, encoding="utf-8") as file:
        spec = file.read()
    texts = corpus(5) + ["", None, "one <|endoftext|> two", "  x  "]
    monkeypatch.setattr(ts, "_loaded", {})
    watched = Watched(ts.encoder_of(spec)._tokenizer)
    ts.encoder_of(spec)._tokenizer = watched
    batch = pa.RecordBatch.from_arrays([pa.array([b"%d" % n for n in range(len(texts))]), pa.array(texts)], ["content", "text"])
    found = pa.Table.from_batches(token_counts._counted(SimpleNamespace(value=spec))(iter([batch])))
    library = Tokenizer.from_str(spec)
    assert found["n_tokens"].to_pylist() == [len(library.encode(t or "", add_special_tokens=False)) for t in texts]
    assert found["content"].to_pylist() == batch.column("content").to_pylist()
    assert 0 < watched.chars < sum(len(t or "") for t in texts) / 5


def test_words_of_letters_go_to_the_model_without_a_split():
    with open(BYTE_BPE, encoding="utf-8") as file:
        spec = file.read()
    library, encoder = Tokenizer.from_str(spec), ts.LibraryEncoder(spec)
    watched = encoder._tokenizer = Watched(encoder._tokenizer)
    # Every letter of the range between others, so all of their bytes.
    letters = [chr(code) for code in range(0x41, 0x250) if ts._LETTERS.fullmatch(chr(code))]
    text = " ".join(["", *[f"x{a}{b}" for a, b in zip(letters, reversed(letters))], *corpus(6)[0].split(",")])
    ids, counts = encoder.encode([text, text])
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids * 2
    assert len(letters) == 450 and 0 < watched.by_texts < watched.chars / 4


@pytest.mark.parametrize("kind", ["unigram", "dropout", "sequence"])
def test_files_that_are_not_read_by_words_are_encoded_whole(kind):
    """Files whose vocabulary is a list, or whose words depend on more than their letters."""
    if kind == "unigram":
        tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0), ("a", -1.0), ("ab", -1.5), (" ", -2.0)], 0, False))
    else:
        tokenizer = Tokenizer.from_file(BYTE_BPE)
        if kind == "dropout":
            tokenizer.model.dropout = 1.0  # no merge at all
        else:
            tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Digits(), tokenizer.pre_tokenizer])
    texts = ["a b ab", "", "ab12 ab1", "abab abc"] * 2
    ids, counts = ts.LibraryEncoder(tokenizer.to_str()).encode(texts)
    want = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert counts.tolist() == [len(one) for one in want]
    assert ids.tolist() == [number for one in want for number in one]
