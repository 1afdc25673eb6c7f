"""Goldens and properties of the scalar functions."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weft.functions import similarity as s
from weft.functions.text import Normaliser, script_of, transliterated

NAMES = [
    ("Modern Construction Enterprises LLC", "modern construction enterprises llc", "modern construction enterprises", "modernconstructionenterprises", 0),
    ("modernconstructionenterprises.com", "modernconstructionenterprises", "modernconstructionenterprises", "modernconstructionenterprises", 1),
    ("www.foo-bar.in", "foo bar", "foo bar", "foobar", 1),
    ("Acme L.L.C.", "acme llc", "acme", "acme", 0),
    ("Smith f/k/a Jones Inc", "smith jones inc", "smith jones", "smithjones", 0),
    ("Internationa1 Traders", "international traders", "international traders", "internationaltraders", 0),
    ("A1 Plumbing", "a1 plumbing", "a1 plumbing", "a1plumbing", 0),
    ("The Company", "the company", "the company", "thecompany", 0),
    ("Émpire & Co", "empire and co", "empire and", "empireand", 0),
    (None, "", "", "", 0),
]
ADDRESSES = [
    ("2246/b MG Road, Pune, Maharashtra", "India", "mg rd pune", "2246/b", "2246/b", "MH"),
    ("Apt 4, 0922 North Main Street, Dallas, TX", "US", "n main st dallas", "4 922", "922", "TX"),
    ("12345 Oak St, Springfield, IL 62701", "US", "oak st springfield il", "12345 62701", "12345", ""),
    ("1st Ave, Washington, DC", "US", "ave washington", "1", "1", "DC"),
    ("<NULL>", "US", "", "", "", ""),
    (None, "US", "", "", "", ""),
    ("12 Rue de la Paix, Pas-de-Calais", "France", "rue paix", "12", "12", "HDF"),
    ("75001, 7 Main Rd", "US", "main rd", "75001 7", "7", ""),
]


@pytest.mark.parametrize(("raw", "norm", "core", "compact", "domain"), NAMES)
def test_names(raw, norm, core, compact, domain):
    assert Normaliser().name(raw) == {"name_norm": norm, "name_core": core, "name_compact": compact, "name_script": "latin", "name_domain": domain}


@pytest.mark.parametrize(("raw", "country", "norm", "nums", "house", "state"), ADDRESSES)
def test_addresses(raw, country, norm, nums, house, state):
    found = Normaliser().address(raw, country)
    assert (found["addr_norm"], found["addr_nums"], found["house_no"], found["state"]) == (norm, nums, house, state)
    assert found["addr_missing"] == int(not norm and not nums)


def test_state_codes_hold_across_countries_unless_strict():
    assert Normaliser().address("1 Road, NY", "France")["state"] == "NY"
    assert Normaliser(strict_country=True).address("1 Road, NY", "France")["state"] == ""
    assert Normaliser().address("Plot 2, MH", "India")["state"] == "MH"
    assert Normaliser().address("Plot 2, महाराष्ट्र", "India")["state"] == "MH"


def test_folding():
    assert script_of("राम Traders") == "DEVANAGARI"
    assert script_of("Traders राम", first_only=True) == "latin"
    assert transliterated("Straße café") == "Strasse cafe"
    assert Normaliser({"राम": "ram"}).name("राम Traders")["name_norm"] == "ram traders"
    assert transliterated("राम").isascii()


def test_similarity_goldens():
    assert s.ratio("kitten", "sitting") == pytest.approx(200 * 4 / 13)
    assert s.ratio("abcd", "badc") == 50
    assert s.ratio("", "") == 100 and s.ratio("", "a") == 0
    assert s.token_sort_ratio("foo bar", "bar foo") == 100
    assert s.token_set_ratio("foo bar", "foo bar baz") == 100
    assert s.token_set_ratio("", "a") == 0
    assert s.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)


texts = st.text("abc ", max_size=14)


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(row[k + 1], new[-1]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(texts, texts)
def test_similarity_properties(a, b):
    assert s.lcs(a, b) == slow_lcs(a, b)
    for f in (s.ratio, s.token_sort_ratio, s.token_set_ratio, s.partial_ratio):
        assert 0 <= f(a, b) <= 100 and f(a, b) == pytest.approx(f(b, a))
    assert s.ratio(a, a) == 100


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=1, max_size=8), st.text("ab", min_size=1, max_size=12))
def test_partial_ratio_is_the_best_window(a, b):
    def best(short, long):
        n = len(short)
        windows = [long[max(0, e - n) : e] for e in range(1, len(long) + n)]
        return max(s.ratio(short, w) for w in windows if w)

    short, long = sorted((a, b), key=len)
    expected = max(best(short, long), best(long, short)) if len(a) == len(b) else best(short, long)
    assert s.partial_ratio(a, b) == pytest.approx(expected)


def test_many_pairs_give_what_one_pair_gives():
    import random

    import numpy as np

    rng, one, two = random.Random(1), [], []
    for k in range(900):
        alphabet = ["ab", "abcde ", "abcdefghijklmnopqrstuvwxyz éß世  "][k % 3]
        a = "".join(rng.choices(alphabet, k=rng.choice([0, 1, 2, 5, 12, 25, 63, 64, 65, 130])))
        b = a if k % 20 == 0 else a[: len(a) // 2] + "".join(rng.choices(alphabet, k=rng.randint(0, 40))) + a[len(a) // 2 :] * (k % 2)
        one.append([a, b][k % 5 == 0])
        two.append([b, a][k % 5 == 0])
    places = np.arange(len(one))
    for scalar, many in s._MANY.items():
        assert np.allclose(many(one, two, places, places), [scalar(a, b) for a, b in zip(one, two, strict=True)], atol=1e-9), scalar.__name__
        assert len(many(one, two, places[:0], places[:0])) == 0
