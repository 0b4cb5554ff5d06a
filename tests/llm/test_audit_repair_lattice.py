"""Filter audit, conversation repair and lattice hashing against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import permutations, product

import numpy as np
import pytest

from habispark.llm import conversation_repair, filter_audit, lattice_dedup

from .conftest import WORDS, prose, words_of

# --- filter audit ------------------------------------------------------------------------------------


def audit_by_hand(rows, labels):
    marks = defaultdict(lambda: [0, 0])
    for doc_id, quality, toxic in labels:
        if doc_id is not None:
            marks[doc_id][0] |= quality == 1
            marks[doc_id][1] |= toxic == 1
    judged = []
    for doc_id, text, source in rows:
        text, words = text or "", words_of(text)
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        fails |= {"D"} if re.search("[#$%&*|]", text) else set()
        fails |= {"E"} if doc_id is not None and any(
            (t or "") == text and i is not None and i < doc_id for i, t, _ in rows
        ) else set()
        judged.append((source or "", fails, *(marks[doc_id] if doc_id is not None else (0, 0))))
    out = {}
    for part in {j[0] for j in judged}:
        mine = [j for j in judged if j[0] == part]
        total = defaultdict(int)
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                failing = [j for j in mine if letter in j[1]]
                gone = [j for j in failing if not before & j[1]]
                total[letter] += len(gone)
                out[part, order, step] = [
                    sum(not (before | {letter}) & j[1] for j in mine), len(gone), len(failing) - len(gone),
                    sum(j[1] == {letter} for j in mine), sum(j[2] for j in gone), sum(j[3] for j in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {key: tuple(map(int, row)) for key, row in out.items()}


@pytest.fixture(scope="module")
def audit_rows():
    rng = random.Random(5)
    rows = []
    for i in range(90):
        text = prose(rng, rng.choice([0, 3, 150, 260]))
        text = text + " A B#" if rng.random() < 0.2 else text
        text = text.upper() if rng.random() < 0.2 else text
        text = " ".join(["same"] * 210) if rng.random() < 0.15 else text
        text = rows[rng.randrange(i)][1] if i and rng.random() < 0.3 else text
        rows.append((i, text, rng.choice(["x", "y", None, ""])))
    rows += [(None, "copied", "x"), (None, "copied", None), (7, "copied", "x"), (8, "copied", "x"), (8, "copied", "x"), (9, None, "z"), (200, prose(rng, 30000), "z")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 95)] + [(3, 1, 1), (None, 1, 1), (999, 1, 1)]
    return rows, labels


def test_audit_equals_counting_by_hand(spark, audit_rows):
    rows, labels = audit_rows
    docs = spark.createDataFrame(
        [(*r, 1, 2, "p") for r in rows], "doc_id long, text string, source string, prefix int, row_id int, part string"
    ).repartition(3)
    marks = spark.createDataFrame([(*r, 5) for r in labels], "doc_id long, quality int, toxic int, part int")
    got = {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in filter_audit.audited(docs, marks).collect()
    }
    assert got == audit_by_hand(rows, labels)


def test_audit_of_empty_tables(spark, audit_rows):
    docs = spark.createDataFrame(audit_rows[0], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audited(docs.limit(0), labels).count() == 0
    assert filter_audit.audited(docs, labels).agg({"good_lost": "sum"}).first()[0] == 0


# --- conversation repair -----------------------------------------------------------------------------

PATTERN = re.compile(r"(s?(ua)+)?")


def text_key(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def damaged_by_hand(rows):
    """Rows after damage, by conversation, in order."""
    space = lambda x: " " if x is None else str(x)
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = space(role), space(text)
        fate = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out[conv] += [(turn, role, text)] * (2 if fate == 3 else 1)
    for found in out.values():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, text_key(r[1], r[2])))
    return out


def repaired_by_hand(rows):
    """Tries every edit of every row, with up to three insertions in a row before, between and behind."""
    seen, facts, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        facts.append((role, text, fault))
    counts["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    numbers = [t for t, _, _ in rows if t is not None]
    counts["gaps"] = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    states = {("", ()): 0}
    inserts = [("I" * n, r) for n in range(4) for r in product(("user", "assistant"), repeat=n)]
    for i in range(len(rows) + 1):
        longer = {}
        for (audit, out), cost in states.items():
            for letters, roles in inserts:
                grown = out + tuple((r, "") for r in roles)
                if not possible(grown):
                    continue
                choices = [("", 0, ())]
                if i < len(rows):
                    role, text, fault = facts[i]
                    choices = [("D", 2, ())]
                    if fault not in ("blank", "duplicate"):
                        extra = 5 * (fault == "truncated")
                        choices += [("K", extra, ((role, text),))]
                        choices += [("R", 1 + extra, ((r, text),)) for r in ("user", "assistant")]
                for letter, more, row in choices:
                    key = audit + letters + letter, grown + row
                    value = cost + 5 * len(letters) + more
                    if possible(key[1]) and longer.get(key, 99999) > value:
                        longer[key] = value
        # Only what can still be the cheapest.
        least = min(longer.values())
        states = {key: value for key, value in longer.items() if value <= least + 15}
    best = min((cost, audit, out) for (audit, out), cost in states.items() if PATTERN.fullmatch("".join(r[:1] or "-" for r, _ in out)))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in best[2]).encode()).hexdigest()
    return counts | {"cost": best[0], "audit": best[1], "repaired_sha256": sha}


def possible(out):
    return re.fullmatch(r"s?(ua)*u?", "".join(r[:1] or "-" for r, _ in out)) is not None


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(11)
    rows = []
    for conv in [*range(120), None]:
        for turn in range(rng.randint(1, 5)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""])
            text = rng.choice(["Yes.", "No", "Fine! \n", " ", "", None, "Same?", "Much  longer. "])
            number = rng.choice([turn, turn, turn, turn * 3, None])
            rows.append((conv, number, role, text))
    return rows


def test_repairs_equal_brute_force(spark, talks):
    df = spark.createDataFrame([(*r, "x", 1) for r in talks], "conv_id long, turn long, role string, text string, audit string, part int")
    got = {r.conv_id: r.asDict() for r in conversation_repair.damaged_and_repaired(df.repartition(5)).collect()}
    after = damaged_by_hand(talks)
    assert set(got) == {r[0] for r in talks}
    for conv, found in got.items():
        assert {k: v for k, v in found.items() if k != "conv_id"} == repaired_by_hand(after.get(conv, [])), (conv, after.get(conv))


def test_one_conversation_over_many_tasks_and_pieces(spark):
    """Cut into pieces and parts, the result is that of one search."""
    rng = random.Random(2)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), f"{rng.choice(WORDS)} {i}{rng.choice(['.', '.', ''])}") for i in range(700)]
    rows += [(2, 5, "user", "again.")] * 90 + [(2, None, "user", "again."), (2, 9, "assistant", "end.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    after, seen, facts = damaged_by_hand(rows)[1], set(), []
    for _, role, text in after:
        go = not text or (role, text) in seen
        seen.add((role, text))
        facts.append((role[:1], go, not go and not text.endswith(".")))
    whole = conversation_repair._piece(facts, conversation_repair.START)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.conv_id: r for r in conversation_repair.repairs(conversation_repair.damaged(df)).collect()}
        turns = conversation_repair.repaired_turns(conversation_repair.turns(df)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert (found[1].cost, found[1].audit) == min(v for s, v in whole.items() if s in (0, 3))
    assert sum(c != "I" for c in found[1].audit) == len(after)
    for conv in (1, 2):
        mine = sorted((t.position, t.role[:1]) for t in turns if t.conv_id == conv)
        assert [p for p, _ in mine] == list(range(len(mine)))
        assert PATTERN.fullmatch("".join(r for _, r in mine))
    assert [(t.role, t.text, t.edit) for t in sorted(turns, key=lambda t: t.position) if t.conv_id == 2] == [
        ("user", "again.", "K"), ("assistant", "end.", "K")
    ]


def test_repair_of_an_empty_table_and_long_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "word " * 400_000 + "?"), (1, 1, "assistant", "ok.")], "conv_id long, turn long, role string, text string")
    assert conversation_repair.damaged_and_repaired(df.limit(0)).count() == 0
    found = conversation_repair.repairs(conversation_repair.turns(df)).first()
    assert (found.cost, found.audit) == (0, "KK")
    text = "user:" + "word " * 400_000 + "?\nassistant:ok."
    digest = conversation_repair.repair_digests(conversation_repair.turns(df), conversation_repair.repairs(conversation_repair.turns(df))).first()
    assert digest.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_agenda_finalises_the_least_first():
    arcs = {"a": [("b", 1, "K"), ("c", 1, "D")], "b": [("d", 1, "K")], "c": [("d", 1, "R")], "d": []}
    step = lambda item, value: [(to, (value[0] + c, value[1] + x)) for to, c, x in arcs[item]]
    found = conversation_repair.lightest([("a", (0, ""))], step, goal="d")
    assert found["d"] == (2, "DR") and list(found) == ["a", "c", "b", "d"]


# --- lattice hashing ---------------------------------------------------------------------------------


def by_hand(rows, threshold):
    units = {}
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v, np.float64)
            u = u / np.abs(u).max()
            units[i] = u / np.linalg.norm(u)
    near = {i: [j for j in units if j != i and i in units and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold] for i in range(len(rows))}
    component = {}
    for i in range(len(rows)):
        if i not in component:
            reach, todo = {i}, [i]
            while todo:
                for j in near[todo.pop()]:
                    if j not in reach:
                        reach.add(j)
                        todo.append(j)
            known = [rows[j][0] for j in reach if rows[j][0] is not None]
            for j in reach:
                component[j] = min(known) if known else None
    return sorted(((rows[i][0], len(near[i]), component[i], rows[i][0] == component[i]) for i in range(len(rows))), key=str)


def clusters(rng, dims):
    """Far vectors, tight and loose groups, chains, copies and scaled copies."""
    rows = [rng.normal(size=dims) for _ in range(150)]
    for size, spread in ((40, 0.1), (25, 0.3), (30, 0.42), (20, 0.5)):
        centre = rng.normal(size=dims)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            noise = rng.normal(size=dims)
            rows.append(centre + spread * noise / np.linalg.norm(noise))
    rows += [rows[0]] * 30 + [rows[1] * 3, rows[1] * 1e-3, rows[2] * 1e12]
    step = rng.normal(size=(2, dims))
    rows += [step[0] * np.cos(a) + step[1] * np.sin(a) for a in np.linspace(0, 1.2, 14)]
    return [[float(np.float32(x)) for x in row] for row in rows]


@pytest.mark.parametrize("dims,threshold", [(64, 0.9), (12, 0.9), (64, 0.97)])
def test_near_vectors_equal_brute_force(spark, dims, threshold):
    rows = list(enumerate(clusters(np.random.default_rng(4), dims)))
    rows += [(900, None), (901, []), (902, [0.0] * dims), (903, [float("nan")] * dims), (904, [1.0, None]), (905, [float("inf")] * dims)]
    rows += [(None, rows[0][1]), (None, [1.0] * dims), (5, rows[7][1]), (5, rows[7][1]), (906, rows[0][1][: dims - 1])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, node int, cls string").repartition(4)
    got = sorted(map(tuple, lattice_dedup.near_vectors(df, threshold).collect()), key=str)
    assert got == by_hand(rows, threshold)


def test_near_vectors_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert lattice_dedup.near_vectors(df).count() == 0


def test_e8_points_are_the_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 2
    near = lattice_dedup.nearest_e8(x)
    assert ((2 * near).astype(int) % 2 == (2 * near[:, :1]).astype(int) % 2).all() and (near.sum(1) % 2 == 0).all()
    own = ((x - near) ** 2).sum(1)
    others = ((x[:, None] - near[:, None] - lattice_dedup.neighbours()[None]) ** 2).sum(2)
    assert (own <= others.min(1) + 1e-9).all() and len(lattice_dedup.neighbours()) == 240


@pytest.mark.parametrize("points", [1, 2])
def test_tables_find_what_the_design_counts_on(points):
    rng = np.random.default_rng(6)
    x, z = rng.normal(size=(2, 2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(1)[:, None] * x
    y = 0.9 * x + np.sqrt(0.19) * z / np.linalg.norm(z, axis=1)[:, None]
    sizes, found = np.full(2000, 64), []
    for table in range(6):
        a, b = (lattice_dedup.cells(v, sizes, table, points, lattice_dedup.STEP, lattice_dedup.PROBES) for v in (x, y))
        found.append((a[:, :1] == b).any(1) | (b[:, :1] == a).any(1))
    assert np.mean(found) >= lattice_dedup.FOUND * lattice_dedup.FOUND_BY_MORE ** (points - 1) - 0.02
