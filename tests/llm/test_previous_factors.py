"""Longest-previous-factor arrays against brute force."""

import numpy as np
import pytest

from stratum.llm.previous_factor import longest_previous_factors, neighbour_lcp, repeated_starts, smaller_before, suffix_names


def common(a, b, length):
    n = 0
    while n < length and a[n] == b[n]:
        n += 1
    return n


def brute_lpf(data, starts, place, length):
    raw = data.tobytes()
    return [max([common(raw[s:s + length], raw[t:t + length], length) for t, q in zip(starts, place) if q < p], default=0) for s, p in zip(starts, place)]


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "a"])
@pytest.mark.parametrize("length", [8, 13, 16, 40, 100])
def test_arrays_equal_brute_force(letters, length):
    rng = np.random.default_rng(length)
    text = rng.choice([ord(c) for c in letters], 260).astype(np.uint8)
    text[150:210] = text[20:80]
    data = np.concatenate([text, np.zeros(2 * length + 16, np.uint8)])
    starts = np.sort(rng.permutation(len(text) - length + 1)[:90])
    place = rng.permutation(len(starts))
    place[3] = place[5] if starts[3] == starts[5] else place[3]
    assert longest_previous_factors(data, starts, place, length).tolist() == brute_lpf(data, starts, place, length)


def test_equal_places_are_one_start():
    data = np.frombuffer(b"abcabcabcabcabcabc" * 3 + bytes(64), np.uint8)
    starts, place = np.array([0, 0, 3, 3, 6]), np.array([4, 4, 2, 2, 9])
    assert longest_previous_factors(data, starts, place, 10).tolist() == brute_lpf(data, starts, place, 10)
    assert longest_previous_factors(data, starts[:0], place[:0], 10).tolist() == []


def test_smaller_places_before():
    rng = np.random.default_rng(2)
    place, lcp = rng.integers(0, 40, 300), rng.integers(0, 9, 300)
    at, low = smaller_before(place, lcp)
    for i in range(300):
        want = max((j for j in range(i) if place[j] < place[i]), default=-1)
        assert at[i] == want and low[i] == (min(lcp[want + 1:i + 1]) if want >= 0 else 0)


def test_neighbours_common_prefixes():
    rng = np.random.default_rng(4)
    data = np.concatenate([rng.choice([97, 98], 400).astype(np.uint8), np.zeros(80, np.uint8)])
    suffixes = np.array(sorted(range(360), key=lambda i: data[i:i + 30].tobytes()))
    lcp = neighbour_lcp(data, suffix_names(data, 30), suffixes, 30)
    assert lcp.tolist() == [0] + [common(data[a:a + 30], data[b:b + 30], 30) for a, b in zip(suffixes, suffixes[1:])]


def test_repeated_starts_of_units():
    rng = np.random.default_rng(6)
    base = bytes(rng.integers(97, 100, 170).astype(np.uint8))
    units, doc, start = [base, base[:120] + b"x" * 50, b"y" * 20 + base[10:160], base], np.array([3, 1, 2, 3]), np.array([500, 40, 0, 500])
    got = set(zip(*(x.tolist() for x in repeated_starts(units, doc, start, 100))))
    seen = [(k, doc[k], start[k] + i, u[i:i + 100]) for k, u in enumerate(units) for i in range(len(u) - 99)]
    want = {(k, p) for k, d, p, w in seen if any(w == w2 and (d2, p2) < (d, p) for _, d2, p2, w2 in seen)}
    assert got == want
