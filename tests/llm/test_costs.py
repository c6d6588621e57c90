"""Guess costs against every segmentation, base spans and license places against plain loops."""

import hashlib
import math
import random
import re

import pytest

from passages.llm import licenses, secrets
from passages.llm.components import components
from passages.llm.secrets import RANK, SERIES, date_cost, guess_cost, known_words, word_cost


def is_series(plain, kind, at, end):
    unit, least, _ = SERIES[kind]
    count, rest = divmod(end - at, unit)
    if rest or count < least:
        return False
    if kind == 1:
        return all(pair in secrets._neighbours() for pair in zip(plain[at:end], plain[at + 1:end]))
    return plain[at:end] == plain[at:at + unit] * count


def cheapest(value, ranks):
    plain = value.translate(secrets.LOWER)
    read = plain.translate(secrets.LEET)
    best = [0.0]
    for end in range(1, len(value) + 1):
        costs = [best[end - 1] + secrets.BRUTE]
        for at in range(end):
            spans = [date_cost(value, at, end)]
            if 3 <= end - at <= secrets.LONGEST_WORD:
                spans.append(word_cost(value, plain, read, at, end, ranks))
            spans += [price((end - at) // unit) for kind, (unit, _, price) in enumerate(SERIES)
                      if is_series(plain, kind, at, end)]
            costs.append(best[at] + min(spans))
        best.append(min(costs))
    return best[-1]


def values(count):
    rng = random.Random(11)
    parts = ["secret", "Passw0rd", "ssss", "abab", "qwer", "1987", "12-05-1999", "zzzzzzzz", "asdf",
             "abcabcabc", "20200101", "xK9#", "trustno1", "princess", "é", "İ"]
    for _ in range(count):
        made = "".join(rng.choice(parts) for _ in range(rng.randint(1, 5)))
        if rng.random() < 0.5:
            made += "".join(rng.choice("aabs123qwe") for _ in range(rng.randint(0, 12)))
        yield made


def test_cost_is_the_minimum_over_all_segmentations():
    ranks = {**RANK, "bass": 500, "saw": 900, "web": 1200}
    for value in values(1500):
        assert math.isclose(guess_cost(value, ranks), cheapest(value, ranks), abs_tol=1e-9), value


def test_common_passwords_are_weak_and_random_ones_strong():
    for value in ("princess1", "trustno1!", "football99", "superman12", "ssssecret"):
        assert guess_cost(value) < secrets.STRONG, value
    assert guess_cost("ssssecret") < 2.5 and guess_cost("xK9#qLm2Zv") >= secrets.STRONG
    assert guess_cost("a" * 50_000) < 6 and guess_cost("abcab" * 10_000) > 100


def test_words_of_all_documents_are_known(spark):
    texts = [("Gondola gondola, viaduct",), ("viaduct GONDOLA zz",), (None,), ("",)]
    ranks = known_words(spark.createDataFrame(texts, "text string"))
    assert ranks["gondola"] == len(RANK) + 1 and ranks["viaduct"] == len(RANK) + 2
    assert "zz" not in ranks and len(known_words(spark.createDataFrame(texts, "text string"), 1)) == len(RANK) + 1
    assert guess_cost("gondolaviaduct", ranks) < guess_cost("gondolaviaduct")


def base_of(text):
    found = []
    name = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for kind, (pattern, flags) in enumerate([(name, re.I | re.A), (r"AKIA[A-Z0-9]+", 0), (r"[0-9a-f]+", 0)]):
        for m in re.finditer(pattern, text, flags):
            size = len(m[2]) if kind == 0 else len(m[0])
            if size >= (6, 20, 24)[kind]:
                found.append((m.start(), kind, m.end()))
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    parts = ["password", "Token", "API_KEY", " = ", ": ", "'", '"', "hunter22", "AKIA", "ABCD1234EFGH5678",
             "0123456789abcdef", "deadbeef", "\n", " ", "é", "x", "=", "ſecret=abcdef1"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert secrets.scan_text(text)["base_sha256"] == hashlib.sha256(base_of(text).encode()).hexdigest()


def test_license_places_equal_a_plain_loop():
    rng = random.Random(5)
    parts = ["under", "the", "MIT", "License", "apache", "version", "2", "cc", "BY", "nc", "é", "x-y", ","]
    for _ in range(2000):
        text = " ".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        text += rng.choice(["", " under the mit license", " cc by nc cc by nc"])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        places = [(i, label) for phrase, label in licenses.BASE_PHRASES.items()
                  for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
        found = licenses.scan_text(text)
        starts = [i for i, _ in places]
        assert (found["n_words"], found["n_base"]) == (len(words), len(places))
        assert (found["first_word"], found["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert found["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(found["base_labels"].split(",")) <= set(found["labels"].split(","))


@pytest.mark.parametrize("text, labels, free", [
    ("é SPDX-License-Identifier: (MIT OR GPL-2.0) WITH Some-exception\nBSD",
     "gpl-2.0 with some-exception,mit with some-exception", True),
    ("spdx license identifier : MIT\n// SPDX-License-Identifier:Zlib", "mit,zlib", True),
    ("SPDX-License-Identifier: MITNFA", "mitnfa", False),
    ("SPDX-License-Identifier MIT", "", False), ("SPDX-License-Identifier:", "", False),
    ("SPDX-License-Identifier: CC-BY-4.0", "cc-by-4.0", True),
])
def test_tags_are_read_where_the_automaton_finds_them(text, labels, free):
    found = licenses.scan_text(text)
    assert (found["labels"], found["permissive"]) == (labels, free)


def test_long_chains_of_links_end_in_few_rounds(spark, monkeypatch):
    from passages.llm import components as module

    rounds, kept = [], module.store
    monkeypatch.setattr(module, "store", lambda df, name: rounds.append(name) or kept(df, name))
    edges = [(i, i + 1) for i in range(2000)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert found.count() == 2001 and found.where("component <> 0").count() == 0
    assert rounds.count("hooks") <= 2 and rounds.count("parents") <= 14
