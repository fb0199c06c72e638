"""What chunks of texts and ranges of hashes tell each other, and what that costs."""

import cProfile
import pstats
import random

import numpy as np
import pyarrow as pa
import pytest

from transferlens.llm import anchors, repeats, suffixes

SIZES = np.array([1, 3, 1, 40, 9, 8, 16])


def runs(numbers, sizes=SIZES):
    return np.split(numbers, np.cumsum(sizes)[:-1])


def chunk(n=300):
    rng = random.Random(4)
    texts = [b"", *(bytes(rng.choice(b"abc  de") for _ in range(rng.randint(0, 900))) for _ in range(n))]
    texts[-1] = texts[1] + texts[2]
    ends = np.cumsum([0, *map(len, texts)])
    copies = pa.array([None], pa.list_(pa.int32()))
    kinds = [pa.array([np.arange(len(texts)).tobytes()]), pa.array([ends.tobytes()]), pa.array([b"".join(texts)]), copies]
    return pa.RecordBatch.from_arrays([pa.array([7]), *kinds], ["chunk", "ids", "ends", "text", "copies"])


def test_runs_are_packed_as_one_by_one():
    rng = np.random.default_rng(3)
    numbers = rng.integers(0, 1 << 63, SIZES.sum(), dtype=np.uint64) >> rng.integers(0, 64, SIZES.sum(), dtype=np.uint64)
    numbers[0], numbers[-1] = 0, np.uint64(2**64 - 1)
    packed = repeats.pack_runs(numbers, SIZES)
    assert packed.to_pylist() == [repeats.pack(part) for part in runs(numbers)]
    for column in (packed, pa.concat_arrays([packed, packed]).slice(len(SIZES)), pa.chunked_array([packed[:2], packed[2:]])):
        back, sizes = repeats.unpack_runs(column)
        assert (back == numbers).all() and (sizes == SIZES).all()


def test_keys_and_bits_of_runs_come_back():
    rng = np.random.default_rng(3)
    keys = np.concatenate([np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64)) for n in SIZES])
    back, sizes = repeats.keys_of_runs(repeats.deltas_of_runs(keys, SIZES))
    assert (back == keys).all() and (sizes == SIZES).all()
    bits = rng.integers(0, 2, SIZES.sum()).astype(bool)
    packed = repeats.pack_bits(bits, SIZES)
    assert packed.to_pylist() == [np.packbits(part).tobytes() for part in runs(bits)]
    assert (repeats.unpack_bits(packed.slice(2), SIZES[2:]) == bits[4:]).all()
    none = np.zeros(0, np.int64)
    assert len(repeats.deltas_of_runs(none.astype(np.uint64), none)) == len(repeats.pack_bits(none, none)) == 0


@pytest.mark.parametrize("scheme", [suffixes.DifferenceCover(), anchors.FixedBlocks()])
def test_cost_of_a_chunk_does_not_grow_with_the_ranges(scheme):
    # Before, each range cost a chunk several calls, and minima by ufunc.at took more time than all else together.
    calls, batch = [], chunk()
    for parts in (12, 6000):
        with cProfile.Profile() as profile:
            asked, = repeats.ask_anchors(scheme, 40, parts)([batch])
        assert asked.num_rows > parts / 12
        stats = pstats.Stats(profile).stats
        assert not [name for _, _, name in stats if name == "<method 'at' of 'numpy.ufunc' objects>"]
        calls.append(sum(s[1] for s in stats.values()))
    assert calls[1] < 1.1 * calls[0]
