from __future__ import annotations

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewell.llm import pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    return sum(sum(map(int, str(int(d) * (1 + i % 2)))) for i, d in enumerate(reversed(digits))) % 10 == 0


def slow_base(text: str | None) -> list[str]:
    found = []
    for order, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(found)]


def card(rnd: random.Random, sep: str = "") -> str:
    while not luhn(d := "4" + "".join(rnd.choices("0123456789", k=15))):
        pass
    return sep.join(d[i : i + 4] for i in range(0, 16, 4))


def phone(rnd: random.Random) -> str:
    return f"({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"


def make_texts() -> list[str | None]:
    rnd = random.Random(13)
    word = lambda: rnd.choice(["the", "ing", "över", "\N{GRINNING FACE}", "call", "on", "é"])
    odd = lambda: "".join(rnd.choices("0123456789 .-+()@ab%\n", k=rnd.randint(1, 40)))
    makers = [
        lambda: f"{word()}.{rnd.randint(0, 99)}@mail{rnd.randint(1, 9)}.example.com", lambda: ".".join(str(rnd.randint(0, 300)) for _ in range(rnd.randint(3, 6))),
        lambda: card(rnd, rnd.choice(["", " ", "-"])), lambda: "+1 " + phone(rnd), odd, lambda: "".join(rnd.choices("0123456789abcdef", k=40)), lambda: "7" * rnd.randint(1, 25),
    ]
    texts: list[str | None] = [" ".join(rnd.choice([*makers, word, word])() for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    texts += [None, "", " ", "a@b.c%x@d.e@f.g a@b..c a@b", "1.2.3.4.5.6.7.8 1.2.3.999 0001.0.0.000255", "9" * 30_000, "1 " * 20_000, "a." * 20_000 + "@x.y", "+" + "1" * 20_000]
    return texts


@pytest.fixture(scope="module")
def found(spark):
    texts = make_texts()
    rnd = random.Random(7)
    extra = {1000: f"pay {card(rnd)} {card(rnd)} now", 1001: f"phone {phone(rnd)} today", 1002: "write to jane.7 [at] mail3.example [dot] com please", 1003: "nothing 12 of 345 kind", 1004: "order 4000000000000001 shipped"}
    docs = spark.createDataFrame([*enumerate(texts), *extra.items()], "doc_id long, text string").repartition(4)
    model = pii.train(docs)
    return {**dict(enumerate(texts)), **extra}, docs, model, {r.doc_id: r for r in pii.digest(pii.find(docs, model, keep=["doc_id"])).collect()}


def test_base_equals_regular_expressions(found):
    texts, _, _, rows = found
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        base = slow_base(text)
        r = rows[i]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), (text, base, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in base) for k in RULES]
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if s in base] == base
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts) and len(set(spans)) == len(spans)


def test_method_adds_what_the_rules_miss(found):
    _, _, model, rows = found
    assert len(model.trees) > 2
    assert rows[1000].spans == "card:4:20,card:21:37" and rows[1000].n_card == 0
    assert rows[1001].spans == "phone:6:20" and rows[1002].spans == "email:9:44"
    assert rows[1003].spans == "" and rows[1004].spans == ""


def test_scores_equal_plain_trees(spark, found):
    _, docs, model, _ = found
    each = pii._proposals(docs, "text").select(F.explode_outer("__all").alias("c")).filter("c is not null")
    for f, s in each.select("c.f", pii.score(model, F.col("c.f"))).distinct().collect():
        total = model.base
        for tree in model.trees:
            while not isinstance(tree, float):
                feature, cut, low, high = tree
                tree = low if f[feature] <= cut else high
            total += tree
        assert abs(s - 1 / (1 + math.exp(-total))) < 1e-12


def test_prefix_sums(spark):
    values = [random.Random(1).randint(0, 9) for _ in range(1000)]
    row = spark.createDataFrame([(values,), ([],)], "v array<int>").select(pii._before(F.col("v"), F.lit(0), lambda a, b: a + b).alias("s")).collect()
    assert row[0].s == [sum(values[:i]) for i in range(1000)] and row[1].s == []


def test_shapes(spark, docs, rows, no_docs):
    model = pii.train(no_docs)
    assert model.thresholds == (2.0,) * 4 and pii.find(no_docs, model).count() == 0
    out = pii.find(docs, model)
    assert out.columns == [*[c for c in docs.columns if c != "kinds"], "kinds", "starts", "ends", "base"] and out.count() == len(rows)


def test_rare_combinations_are_learned_from(spark, found, monkeypatch):
    _, docs, model, _ = found
    monkeypatch.setattr(pii, "MAX_COMBINATIONS", 2, raising=False)
    again = pii.train(docs)
    assert len(again.trees) == len(model.trees) and again.base == pytest.approx(model.base)
