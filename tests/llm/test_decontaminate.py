"""Overlaps by brute force: every diagonal that shares a seed, word by word."""

import random
import time

import pyarrow as pa
import pytest

pytest.importorskip("tamiz.llm")

from tamiz.llm import decontaminate as d  # noqa: E402
from tamiz.llm.words import NOT_ALPHANUMERIC, text_slices, word_hashes  # noqa: E402


def overlaps(items, texts):
    index = d.BenchmarkIndex.of(list(range(len(items))), pa.array(items, pa.string()))
    index.build()
    out = []
    for _, data, offsets in text_slices(pa.array(texts, pa.string())):
        words, begins = word_hashes(data, offsets, NOT_ALPHANUMERIC)
        found = index.overlaps(words, begins)
        out += [found.get(text, {}) for text in range(len(begins) - 1)]
    return out


def seeds_of(words, masks):
    return [
        (mask, place, tuple(words[place + n] for n, used in enumerate(mask) if used == "1"))
        for mask in masks
        for place in range(len(words) - len(mask) + 1)
    ]


def brute(items, text):
    text, found = (text or "").split(), {}
    for number, item in enumerate(items):
        item = item.split()
        masks = [m for m in d.MASKS if len(m) <= len(item)] or (["1" * len(item)] if item else [])
        own = seeds_of(item, masks)
        shifts = {
            place - at for mask, place, words in seeds_of(text, masks) for other, at, same in own if (mask, words) == (other, same)
        }
        for shift in shifts:
            best = None
            low, high = max(0, -shift), min(len(item), len(text) - shift)
            scores = [0]
            for place in range(low, high):
                scores.append(scores[-1] + (1 if item[place] == text[place + shift] else -d.MISMATCH))
            gains = [scores[end] - min(scores[: end + 1]) for end in range(len(scores))]
            last = gains.index(max(gains))
            first = scores[: last + 1].index(min(scores[: last + 1]))
            matched = sum(item[low + n] == text[low + n + shift] for n in range(first, last))
            if matched >= d.ENOUGH_WORDS or matched >= d.ENOUGH_SHARE * len(item):
                best = (matched, len(item), low + first + shift)
            if best and best > found.get(number, (0,)):
                found[number] = best
    return found


@pytest.mark.parametrize("lanes", [1 << 20, 5])
@pytest.mark.parametrize("kinds", [1, 2, 3, 40])
def test_overlaps_equal_brute_force(monkeypatch, lanes, kinds):
    monkeypatch.setattr(d, "LANES", lanes)
    chosen = random.Random(kinds)
    words = lambda most: [f"w{chosen.randrange(kinds)}" for _ in range(chosen.randrange(most))]
    met = 0
    for _ in range(25):
        items = [" ".join(words(40)) for _ in range(chosen.randrange(1, 4))]
        planted = items[0].split()
        for _ in range(len(planted) // 8):
            planted[chosen.randrange(len(planted))] = "other"
        texts = [" ".join(words(70)), " ".join(words(20) + planted + words(20)), "", None, items[-1]]
        found = overlaps(items, texts)
        assert found == [brute(items, text) for text in texts]
        met += sum(map(len, found))
    assert met > 20


def test_a_repeated_word_makes_no_product():
    started = time.process_time()
    assert overlaps([" ".join(["a"] * 1000)], [" ".join(["a"] * 300_000)]) == [{0: (1000, 1000, 299_000)}]
    assert time.process_time() - started < 10
