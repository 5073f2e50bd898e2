"""Short, misspelt and swapped terms of the lexicon, and lexicons of any size."""

from __future__ import annotations

import random

from nimbra.llm import op1_toxicity

CLEAN = "therein onward edited thistle another reason whether ending slum"


def test_short_and_misspelt_terms_are_hits(spark):
    rows = [(f"{CLEAN} you {term} {CLEAN}", 1) for term in ("zax", "scum", "idiot", "trash") for _ in range(40)]
    rows += [(f"{CLEAN} you {CLEAN}", 0)] * 160
    model = op1_toxicity.fit(spark.createDataFrame(rows, "text string, label int"))
    assert {"zax", "scum", "idiot", "trash"} <= set(model.weights)
    scanner = model.scanner()
    hits = {w: [h[1] for h in scanner.hits([w])] for w in ("zax", "skum", "scumm", "scu", "idoit", "tarsh", "slum", "zxa")}
    expected = {"zax": ["zax"], "skum": ["scum"], "scumm": ["scum"], "scu": ["scum"], "idoit": ["idiot"], "tarsh": ["trash"]}
    assert hits == expected | {"slum": [], "zxa": []}
    assert scanner.hits(["idoit"])[0][2] == 1
    assert model.score(scanner.features("you zax")) > 0.5 > model.score(scanner.features(f"you {CLEAN}"))


def test_the_lexicon_is_not_cut(spark):
    terms = " ".join(f"bad{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}" for i in range(5000))
    rows = [(terms, 1)] * 12 + [(CLEAN, 0)] * 12
    assert len(op1_toxicity.fit(spark.createDataFrame(rows, "text string, label int")).weights) == 5000


def test_sieve_lets_all_near_words_through():
    chance = random.Random(1)
    terms = {"".join(chance.choices("abcdé", k=chance.randint(2, 30))): 1.0 for _ in range(60)}
    lexicon = op1_toxicity.Lexicon(terms, swaps=True)
    sieve = op1_toxicity.Sieve(lexicon)
    words = []
    for term in terms:
        for _ in range(30):
            word = list(term)
            for _ in range(chance.randint(0, op1_toxicity.allowed_edits(term))):
                at = chance.randrange(len(word))
                change = chance.choice(["drop", "put", "swap", "set"])
                if change == "drop":
                    del word[at]
                elif change == "put":
                    word.insert(at, chance.choice("abcdé"))
                elif change == "swap":
                    word[at : at + 2] = word[at : at + 2][::-1]
                else:
                    word[at] = chance.choice("abcdé🙂")
                word = word or ["a"]
            words.append("".join(word))
    words += ["", "x" * 5000]
    near = sieve.near(words)
    for word, may in zip(words, near, strict=True):
        best = min(((distance(word, t), t) for t in terms if distance(word, t) <= op1_toxicity.allowed_edits(t)), default=None)
        match = lexicon.match(word)
        assert may or match is None or word in terms
        if best is not None:
            assert match is not None and match[1] <= best[0]


def distance(a: str, b: str) -> int:
    if abs(len(a) - len(b)) > 2:
        return 99
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
