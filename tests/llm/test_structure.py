import hashlib
import itertools
import random
import re
import zlib

import pytest

from sylva.llm import structure as st

CODES = [st._OTHER, st._S, st._U, st._A, st._U | st._CUT, st._A | st._CUT, st._U | st._GONE, st._OTHER | st._CUT]


def slow(codes):
    """The least (cost, letters), by running through all ways: per row and state the least string."""
    best = {st.START: (0, "")}
    for code in codes:
        after = {}
        for state, (cost, letters) in best.items():
            for ins in range(3):
                at = state
                for _ in range(ins):
                    at = st._SPOKEN[at]
                extra = 1 if code & st._CUT else 0
                ways = [("D", 3, at)]
                if not code & st._GONE:
                    ways.append(("R", 2 + extra, st._SPOKEN[at]))
                    if (code & 3, at) in st._KEPT:
                        ways.append(("K", extra, st._KEPT[code & 3, at]))
                for letter, more, to in ways:
                    way = (cost + 2 * ins + more, letters + "I" * ins + letter)
                    after[to] = min(after.get(to, way), way)
        best = after
    return min((c + 2 * len(st._TAIL[s]), w + st._TAIL[s]) for s, (c, w) in best.items())


def test_all_short_conversations():
    for n in range(5):
        for codes in itertools.product(CODES, repeat=n):
            assert st.cheapest(bytes(codes)) == slow(codes), codes


@pytest.mark.parametrize("block", [1, 3, 32])
def test_long_conversations_in_blocks(block):
    rng = random.Random(block)
    for _ in range(60):
        codes = [rng.choice(CODES) for _ in range(rng.randint(5, 90))]
        assert st.cheapest(bytes(codes), block) == slow(codes)


def test_mostly_sound_conversation_of_many_rows():
    rng = random.Random(9)
    codes = [rng.choice(CODES) if rng.random() < 0.05 else (st._U, st._A)[i % 2] for i in range(20_000)]
    assert st.cheapest(bytes(codes)) == slow(codes)


def repaired(rows):
    """(report, lines) of damaged rows (turn, role, text), by the rules as they are written."""
    rows = sorted(((t is not None, t or 0), " " if r is None else r, " " if x is None else x) for t, r, x in rows)
    seen, codes, counts = set(), [], dict.fromkeys(st.FAULTS, 0)
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        codes.append({"s": 1, "u": 2, "a": 3}.get(role[:1], 0) | (4 if fault in ("blank", "duplicate") else 8 if fault else 0))
    turns = [t for (known, t), _, _ in rows if known]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = slow(codes)
    state, lines, left = st.START, [], iter(rows)
    for letter in audit:
        _, role, text = next(left) if letter != "I" else (None, None, "")
        if letter != "D":
            state = st._SPOKEN[state] if letter != "K" else st._KEPT[{"s": 1, "u": 2, "a": 3}[role[0]], state]
            lines.append(f"{role if letter == 'K' else st._ROLE[state]}:{text}")
    return {"gaps": gaps, **counts, "illegal": illegal, "cost": cost, "audit": audit}, lines


TEXTS = ["Yes.", "yes", "", " ", None, "What?\n", "no! ", "x\x85", "é. ", "long " * 3000 + "."]
ROLES = ["user", "assistant", "system", None, "", "tool", "usher"]


def some(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(60), None]:
        for k in range(rng.randint(0, 12)):
            rows.append((conv, rng.choice([k, k, k, k + 2, None]), rng.choice(ROLES[:3] if rng.random() < 0.8 else ROLES), rng.choice(TEXTS), "x"))
    rows += [(70, 1, "user", "Same.", "x")] * 5 + [(71, None, None, None, "x")] * 2
    rows += [(72, k, ("user", "assistant")[k % 2], f"Line {k}.", "x") for k in range(500)]
    return rows


def test_repair(spark):
    rows = some(1)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string").repartition(5)
    convs = {}
    for conv, turn, role, text, _ in rows:
        convs.setdefault(conv, []).append((turn, role, text))
    turns = {}
    for r in st.repaired_turns(df).orderBy("conv_id", "seq").collect():
        turns.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    reports = {r["conv_id"]: r.asDict() for r in st.digests(st.repair(df)).collect()}
    assert set(reports) == set(convs)
    for conv, given in convs.items():
        report, lines = repaired(given)
        assert {k: reports[conv][k] for k in report} == report, conv
        assert turns.get(conv, []) == lines
        assert reports[conv]["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
    empty = spark.createDataFrame([], df.schema)
    assert st.repair(empty).count() == 0 and st.digests(st.repair(empty)).count() == 0


def test_query(spark, tmp_path):
    rows = [(c, t, r, x) for c, t, r, x, _ in some(2)] + [(80 + c, 0, "user", "Alone.") for c in range(60)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r.asDict() for r in st.op13_structure_repair(spark, str(tmp_path)).collect()}
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    assert set(got) == set(convs) and any(not rows for rows in convs.values())
    for conv, kept in convs.items():
        report, lines = repaired(kept)
        assert got[conv] == {"conv_id": conv, **report, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
