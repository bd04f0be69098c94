"""Toxicity, whitening and conversation repair, each against a plain version, with nulls, empty tables and clashing names."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from vigiltx.llm import conversations, toxicity, whitening

# Toxicity


def plain_ratio(rows: list[tuple[str, int]], text: str) -> float:
    """Sum of the log-likelihood ratios of ``text``, from dictionaries of counts."""

    def symbols(t):
        return [0, 0, *toxicity.folded(t).tolist(), 0]

    grams = [Counter(), Counter()]
    for t, y in rows:
        s = symbols(t)
        grams[y].update(zip(s, s[1:], s[2:]))
    pairs = [Counter(g[1:] for g in c) for c in grams]  # by the number of symbols before them
    seen = {p for c in pairs for p in c}
    follows = Counter(z for _, z in seen)

    def d(counts):
        once, twice = (sum(1 for v in counts.values() if v == k) for k in (1, 2))
        return min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)

    def base(z):
        return (max(follows[z] - d(follows), 0) + d(follows) * len(follows) / 256) / len(seen)

    def layer(counts, context, event, below):
        total = sum(n for g, n in counts.items() if g[:-1] == context)
        if not total:
            return below
        types = sum(1 for g in counts if g[:-1] == context)
        return (max(counts[event] - d(counts), 0) + d(counts) * types * below) / total if event in counts else d(counts) * types * below / total

    def p(c, x, y, z):
        return layer(grams[c], (x, y), (x, y, z), layer(pairs[c], (y,), (y, z), base(z)))

    s = symbols(text)
    return sum(math.log(p(1, *g) / p(0, *g)) for g in zip(s, s[1:], s[2:]))


def test_ratios_equal_plain_counts(spark):
    rows = [("a cat sat", 0), ("the cat ran", 0), ("a Bad bad cat", 1), ("bad é日", 1), ("", 0)]
    table = spark.createDataFrame([(t, y, 0) for t, y in rows], "text string, label int, half int")
    counts = toxicity.count_trigrams(table).toPandas().rename(columns={"label": "toxic"})
    model = toxicity.RatioModel.build(counts)
    for text in ("bad cat", "", "zzz", "the cat sat", "日é a"):
        history, symbols = next(toxicity.pieces(text))
        assert model.three[toxicity.trigrams(history, symbols)].sum() == pytest.approx(plain_ratio(rows, text), abs=1e-4)


def test_pieces_lose_nothing():
    text = "some words and more " * 30 + "x" * 90
    whole = toxicity.trigrams(*next(toxicity.pieces(text)))
    cut = [toxicity.trigrams(*p) for p in toxicity.pieces(text, 50)]
    assert len(cut) > 5 and (np.concatenate(cut) == whole).all()


def toxic_rows():
    draw = random.Random(4)
    words = "river house stone over under light green field".split()
    rows = []
    for i in range(300):
        said = [draw.choice(words) for _ in range(draw.randint(8, 40))]
        if i % 6 == 0:
            said[draw.randrange(len(said))] = draw.choice(["zugh", "kaxq"])
            said[draw.randrange(len(said))] = draw.choice(["zughs", "kaxqy"])
        rows.append((i, " ".join(said), int(i % 6 == 0)))
    return rows


def test_toxicity(spark):
    rows = toxic_rows()
    texts = [r[:2] for r in rows] + [(900, None), (901, ""), (902, " \n"), (903, "zugh " * 60_000), (None, "river"), rows[0][:2]]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("score", F.lit("own")).withColumn("label", F.lit(1))
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(0, 1), (901, 7), (902, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.score_toxicity(docs, labels, toxicity.held_out(F.col("doc_id")))
    assert set(out.columns) == {"doc_id", "text", "label", "score", "predicted"}
    got = out.collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {r[0]: r[2] for r in rows}
    aside = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == truth[r.doc_id] for r in aside]) > 0.95
    assert {r.predicted for r in got if r.doc_id == 903} == {1}
    none = docs.where("false")
    assert toxicity.score_toxicity(none, labels).count() == 0
    for known, sure in ((labels.where("false"), 0.5), (labels.where("toxic = 1"), 0.99), (labels.where("toxic = 0"), 0.01)):
        assert {round(r.score, 2) for r in toxicity.score_toxicity(docs, known).collect()} == {sure}


# Whitening


def plain_whitening(vectors):
    x = np.floor(np.array(vectors, float) * 64) + 1_000_000
    fit = np.unique(x, axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    order = np.argsort(-values)
    return (x - fit.mean(axis=0)) @ axes[:, order] / np.sqrt(np.maximum(values[order], 1e-300)), values[order]


def test_whitening(spark):
    draw = np.random.default_rng(2)
    base = draw.normal(size=(200, 6)) * [3, 2, 1, 0.5, 0.3, 0.1]
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(500, rows[0][1]), (501, rows[0][1]), (502, None), (503, []), (504, [1.0] * 5), (505, [None] * 6), (506, [float("nan")] * 6), (507, [float("inf")] * 6), (508, [1e30] * 6), (None, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit("own")).withColumn("x", F.lit("mine")).repartition(5)
    out = whitening.whiten(df, components=4)
    assert set(out.columns) == {"vec_id", "embedding", "x", *whitening.ADDED}
    got = out.collect()
    taken = [r for r in rows if r[0] is None or r[0] < 502]
    assert len(got) == 4 * len(taken)
    want, values = plain_whitening([r[1] for r in taken])
    by_id = {r[0]: w for r, w in zip(taken, want, strict=True)}
    signs = np.sign([next(g.whitened for g in got if g.vec_id == 0 and g.component == k + 1) * by_id[0][k] for k in range(4)])
    distinct = np.unique(np.floor(np.array([r[1] for r in taken]) * 64).astype(int), axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    for g in got:
        assert g.whitened == pytest.approx(by_id[g.vec_id][g.component - 1] * signs[g.component - 1], abs=1e-9)
        assert g.n == n and g.explained == pytest.approx(values[g.component - 1] / values.sum(), rel=1e-9) and g.identity_error < 1e-12
        assert int(g.deviation) == sum((n * int(c) - int(s)) ** 2 for c, s in zip(np.floor(np.array(g.embedding) * 64).astype(int), sums, strict=True))


@pytest.mark.parametrize("rows", [[], [None, []], [[1.0, 2.0]] * 3])
def test_whitening_of_nothing(spark, rows):
    df = spark.createDataFrame([(v,) for v in rows], "embedding array<double>")
    out = whitening.whiten(df)
    assert out.count() == 0 and out.columns == ["embedding", *whitening.ADDED]


def test_whitening_of_low_rank(spark):
    df = spark.createDataFrame([([i / 64, 2 * i / 64, 1e15],) for i in range(5)], "embedding array<double>")
    got = whitening.whiten(df).collect()
    assert {r.component for r in got} == {1} and sorted(round(abs(r.whitened), 6) for r in got) == [0, 0.707107, 0.707107, 1.414214, 1.414214]


def as_scatter(y):
    n, s = len(y), y.sum(axis=0)
    m = y.T.astype(object) @ y.astype(object)
    return whitening.Scatter(n, [int(v) for v in s], [[int(n * m[i, j] - s[i] * s[j]) for j in range(len(s))] for i in range(len(s))])


def test_equal_variances_give_an_orthonormal_basis():
    y = np.concatenate([np.eye(5, dtype=int) * k for k in (-3, 3)] + [np.zeros((2, 5), int)])
    made = whitening.solve(as_scatter(y), 16)
    assert made.variance == pytest.approx([1.5] * 5) and np.abs(made.vectors @ made.vectors.T - np.eye(5)).max() < 1e-14
    assert made.identity_error < 1e-14


def test_characteristic_polynomial():
    draw = np.random.default_rng(6)
    for d in (1, 2, 3, 7):
        a = draw.integers(-9, 9, (d + 2, d))
        m = (a.T @ a).tolist()
        p = whitening.characteristic(m)
        # Faddeev and LeVerrier in whole numbers: coefficients of np.poly lose their last digits from 10^14 on.
        exact, want, step = np.array(m, object), [1], np.zeros((d, d), object)
        for k in range(1, d + 1):
            step = exact @ step + want[0] * np.eye(d, dtype=object)
            want.insert(0, -int(np.trace(exact @ step)) // k)
        assert p == want
    # (t - 1)^2 (t - 4)^3 and its repeated part
    p = [round(c) for c in np.poly([1, 1, 4, 4, 4])[::-1]]
    assert whitening.repeated_part(p) == [round(c) for c in np.poly([1, 4, 4])[::-1]]
    assert whitening.top_roots(p, 4) == [(3, 3), (0, 2)]


@pytest.mark.parametrize("size", [5, 19, 20, 35, 60])
def test_products_are_exact(size):
    y = np.random.default_rng(size).integers(-(2**size), 2**size, (4500 if size < 30 else 50, 3))
    assert (whitening.products(y) == y.T.astype(object) @ y.astype(object)).all()


# Conversations


def plain_repair(rows):
    """The cheapest (cost, audit, repaired), by trying every sequence of edits with few insertions."""
    seen, faults = set(), []
    for role, text in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        kept = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if blank else "duplicate" if (role, text) in seen else "" if kept[-1] in ".!?" else "truncated")
        seen.add((role, text))
    best = None
    for choice in itertools.product("DKR", repeat=len(rows)):
        if any(c != "D" and f in ("blank", "duplicate") for c, f in zip(choice, faults, strict=True)):
            continue
        cost = sum({"D": 2, "K": 0, "R": 1}[c] + (5 if f == "truncated" and c != "D" else 0) for c, f in zip(choice, faults, strict=True))
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            if sum(inserts) > 2 or best is not None and cost + 5 * sum(inserts) > best[0]:
                continue
            audit = "".join("I" * k + c for k, c in zip(inserts, (*choice, ""), strict=True))
            if best is not None and (cost + 5 * sum(inserts), audit) >= best[:2]:
                continue
            free = [i for i, e in enumerate(audit) if e in "RI"]
            for roles in itertools.product(("user", "assistant"), repeat=len(free)):
                at, lines, given = 0, [], dict(zip(free, roles, strict=True))
                for i, e in enumerate(audit):
                    if e == "I":
                        lines.append((given[i], ""))
                        continue
                    role, text = rows[at]
                    at += 1
                    if e != "D":
                        lines.append((given.get(i, role), text))
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines)):
                    best = (cost + 5 * sum(inserts), audit, "\n".join(f"{r}:{t}" for r, t in lines))
                    break
    return best, Counter(faults)


SAY = [("user", "Hi."), ("assistant", "Yes!"), ("system", "Be kind."), ("user", "cut"), ("assistant", " "), ("tool", "x?"), ("user", "Hi."), ("", "e."), ("assistant", "no")]


def test_repair_is_the_cheapest():
    draw = random.Random(8)
    for _ in range(60):
        rows = [draw.choice(SAY) for _ in range(draw.randint(0, 4))]
        (cost, audit, text), faults = plain_repair(rows)
        got = conversations.repaired(rows)
        assert (got["cost"], got["audit"]) == (cost, audit), rows
        assert got["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert all(got[k] == faults[k] for k in ("blank", "duplicate", "truncated"))


def test_agenda_pops_in_order(monkeypatch):
    popped, pop = [], conversations.heapq.heappop
    monkeypatch.setattr(conversations.heapq, "heappop", lambda h: popped.append(pop(h)) or popped[-1])
    conversations.derive([("u", 0), ("u", 1), ("", 2), ("s", 0)], conversations.EMPTY, conversations.RepairRules())
    assert [p[:2] for p in popped] == sorted(p[:2] for p in popped) and len(popped) > 10


def made_conversations():
    draw = random.Random(9)
    rows = [(c, t, *draw.choice(SAY)) for c in range(40) for t in range(draw.randint(1, 7))]
    rows += [(77, t // 2, *draw.choice(SAY + [("user", f"n{t}.")])) for t in range(300)]
    rows += [(None, 1, "user", "a."), (None, None, "assistant", "b."), (5, None, None, None), (78, None, None, "c."), (78, None, "user", None), rows[3], rows[3]]
    rows += [(79, 0, "user", "é日🎉."), (79, 3, "assistant", "long " * 50_000 + ".")]
    return rows


def plain_table(rows):
    kept, out = defaultdict(list), {}
    for conv, turn, role, text in rows:
        kept[conv]
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept[conv] += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, lines in kept.items():
        lines.sort()
        turns = {t for known, t, _, _ in lines if known}
        out[conv] = conversations.repaired([(r, t) for _, _, r, t in lines])
        out[conv]["gaps"] = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        roles = [r[:1] for _, _, r, _ in lines]
        assert out[conv]["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    return out


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_damaged_and_repaired(spark, parts):
    rows = made_conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("audit", F.lit("own")).repartition(parts)
    got = {r.conv_id: r.asDict() for r in conversations.damaged_and_repaired(df).collect()}
    want = plain_table(rows)
    assert len(got) == len(want) == len({r[0] for r in rows})
    for conv, row in want.items():
        assert {k: v for k, v in got[conv].items() if k != "conv_id"} == row
    none = conversations.damaged_and_repaired(df.where("false"))
    assert none.count() == 0 and none.columns == ["conv_id", *conversations.ADDED]


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    row = conversations.damaged_and_repaired(spark.createDataFrame([(1, turn, "user", "a.")], "conv_id long, turn long, role string, text string")).first()
    assert row.asDict() == {"conv_id": 1, **dict.fromkeys(conversations.ADDED[:6], 0), "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}


@pytest.mark.parametrize("size", [3, 50])
def test_long_conversations_in_pieces(spark, size):
    rows = conversations.damage(spark.createDataFrame(made_conversations(), "conv_id long, turn long, role string, text string"))
    rows = rows.select(conversations.key_of().alias("key"), *conversations.ORDER)
    lines = defaultdict(list)
    for r in rows.collect():
        lines[r.key].append((r.turn is not None, r.turn or 0, r.role, r.text))
    rules = conversations.RepairRules(rows=size)
    for r in conversations._repair_long(rows, rules).collect():
        want = conversations.repaired([(a, b) for _, _, a, b in sorted(lines.pop(r.key))])
        assert {k: r[k] for k in want} == want
    assert not lines
