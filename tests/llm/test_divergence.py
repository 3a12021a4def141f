"""Source divergences against plain counting."""

import random
import re
from collections import Counter, defaultdict

from stratalake.llm import divergence

DOCS = "doc_id long, text string, lang string, source string"


def lowered(term):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in term)


def plain(rows, min_docs, top):
    held, counts, groups = defaultdict(set), Counter(), set()
    for number, (_, text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for term in map(lowered, re.findall(divergence.TERM, text or "")):
            held[lang, term].add(number)
            counts[lang, source, term] += 1
    found = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (g, t), d in held.items() if g == lang and len(d) >= min_docs)
        sources = sorted(s for g, s in groups if g == lang)

        def shares(of, kept=kept, lang=lang):
            n = [sum(counts[lang, s, t] for s in of) for t in kept]
            return [1 + 10**9 * (c + 2) // (sum(n) + 2 * len(kept)) for c in n]

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        whole = shares(sources)
        for a in sources:
            p = shares([a])
            pairs = [(-sum(map(f, p, shares([b]))), b.encode()) for b in sources if b != a]
            terms = [
                (-f(x, y), t.encode()) for t, x, y in zip(kept, p, whole, strict=True)
                if counts[lang, a, t] and x > y
            ]
            for part, values in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                found |= {
                    (lang, a, part, item.decode(), -v, rank)
                    for rank, (v, item) in enumerate(values, 1)
                }
    return found


def invented(rows=160):
    numbers = random.Random(3)
    stems = [f"{a}{b}" for a in "kmprst" for b in ("ala", "ore", "ürü", "Ix", "漢字")]
    marks = ["", "", ",", ".", "!", "'s", "-", "--up", "2", " ", " x"]
    made = []
    for i in range(rows):
        words = [numbers.choice(stems) + numbers.choice(marks) for _ in range(numbers.randrange(40))]
        lang = numbers.choice(["en", "en", "fr", None])
        made.append((i, numbers.choice([" ", "\n", "\t \r", "\x0b"]).join(words), lang,
                     numbers.choice(["a", "b", "c", "é", None, ""])))
    return made


EDGES = [
    (None, None, None, None),
    (1, "", "en", "empty"),
    (1, "", "en", "empty"),
    (2, "12 34 !!", "en", "digits"),
    (3, "alone", "xx", "only"),
    (4, "x" * 200_000 + " kala", "fr", "long"),
    (5, "kala " * 50_000, "fr", "long"),
    (6, "Kala KALA kala, kala-kala", "fr", "long"),
]


def test_divergences_are_those_of_plain_counting(spark, monkeypatch):
    rows = invented() + EDGES
    # Many cells, and documents counted in several pieces.
    monkeypatch.setattr(divergence, "TERMS", 7)
    monkeypatch.setattr(divergence, "SOURCES", 2)
    monkeypatch.setattr(divergence, "PIECE", 3000)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    for min_docs, top in ((10, 10), (3, 2), (1, 100)):
        got = [tuple(r) for r in divergence.audit_sources(docs, min_docs, top).collect()]
        assert len(got) == len(set(got))
        assert set(got) == plain(rows, min_docs, top)


def test_terms_spread_over_many_chunks_are_counted_by_documents(spark):
    # Nine documents, the term in two chunks of each: its chunks sum up to 18 documents.
    rows = [(i, f"same, same. other{'' if i else 's'} w{i}! same{i}", "en", "ab"[i % 2]) for i in range(9)]
    rows += [(9, "other", "en", "a")]
    docs = spark.createDataFrame(rows, DOCS)
    got = {tuple(r) for r in divergence.audit_sources(docs, 10, 10).collect()}
    assert got == plain(rows, 10, 10)
    assert got == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}
    assert {tuple(r) for r in divergence.audit_sources(docs, 9, 10).collect()} == plain(rows, 9, 10)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame(invented(40), DOCS)
    clash = docs.selectExpr("*", "1 AS term", "2 AS chunk", "3 AS row", "4 AS count", "5 AS total", "6 AS rank")
    expected = sorted(map(tuple, divergence.audit_sources(docs, 2).collect()))
    assert sorted(map(tuple, divergence.audit_sources(clash, 2).collect())) == expected
    assert divergence.audit_sources(docs.limit(0)).count() == 0
