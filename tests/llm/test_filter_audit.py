"""The audit against a plain cascade over every document, and the diagram's structure under swaps."""

from __future__ import annotations

import random
import re
from itertools import permutations

from pricefold.llm import filter_audit
from tests.conftest import rows

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, labels):
    """Every filter of every order applied to every document."""
    out = []
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    texts = [(d, t or "", lang or "") for d, t, lang in docs]
    fails = []
    for d, t, _ in texts:
        w = WORDS.findall(t)
        fails.append({"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": any(d is not None and e is not None and e < d and u == t for e, u, _ in texts)})
    for part in {p for _, _, p in texts}:
        mine = [i for i, x in enumerate(texts) if x[2] == part]
        steps = []
        for order in permutations("ABCDE"):
            alive = set(mine)
            for step, c in enumerate(order, 1):
                gone = {i for i in alive if fails[i][c]}
                before = {i for i in mine if fails[i][c]} - alive
                alive -= gone
                alone = sum(fails[i][c] and sum(fails[i].values()) == 1 for i in mine)
                steps.append(["".join(order), step, len(alive), len(gone), len(before), alone, sum(texts[i][0] in good for i in gone), sum(texts[i][0] in toxic for i in gone), c])
        for s in steps:
            out.append((part, *s[:-1], sum(x[3] for x in steps if x[-1] == s[-1])))
    return out


def some_documents(rng):
    word = lambda: rng.choice(["the", "Cat", "UPPER", "x", "é", "naïve", "a#b"] + [f"w{i}" for i in range(200)])
    texts = [rng.choice([" ", "\t", "\n\n"]).join(word() for _ in range(rng.choice([0, 1, 50, 99, 100, 150]))) for _ in range(25)]
    texts += [None, "", " \r\n\x0b\x0c ", "SHOUT " * 120, "\x1f\x85" * 3, "word " * 30_000, " ".join(map(str, range(120)))]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(120)]
    docs += [docs[3], (7, docs[3][1], "de"), (None, docs[3][1], "en"), (None, None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(90)] + [(5, 1, 1), (5, 0, 0), (None, 1, 1), (9999, 1, 1)]
    return docs, labels


def test_against_plain_cascade(spark):
    docs, labels = some_documents(random.Random(3))
    frame = spark.createDataFrame([(*d, "x", 7) for d in docs], "doc_id long, text string, lang string, part string, bits int")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    masks = filter_audit.mask_counts(frame.repartition(3), known)
    assert rows(filter_audit.audited(masks)) == sorted(plain(docs, labels), key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert filter_audit.audited(filter_audit.mask_counts(frame.limit(0), known)).count() == 0
    assert filter_audit.audited(filter_audit.mask_counts(frame, known.limit(0))).agg({"good_lost": "sum"}).first()[0] == 0


def test_swaps_visit_every_order_and_keep_the_diagram():
    rng = random.Random(1)
    for n in (1, 2, 3, 5):
        counts = {m: (rng.randint(0, 3), rng.randint(0, 2), 0) for m in range(2**n) if rng.random() < 0.7}
        diagram, seen = filter_audit.Diagram(counts, n), set()
        for i in [None, *filter_audit.adjacent_swaps(n)]:
            if i is not None:
                diagram.swap(i)
            seen.add(tuple(diagram.order))
            fresh = filter_audit.Diagram({sum(1 << k for k, f in enumerate(diagram.order) if m >> f & 1): c for m, c in counts.items()}, n)
            assert [len(x) for x in diagram.levels] == [len(x) for x in fresh.levels]  # equal nodes stay one
            assert [(k, g) for _, k, g in diagram.steps()] == [(k, g) for _, k, g in fresh.steps()]
        assert len(seen) == len(list(permutations(range(n))))
