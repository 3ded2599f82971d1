import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from linkforge.llm import conversation_repair, queries
from linkforge.llm.role_grammar import FLUSH_ROWS, Repair, RoleGrammar

TYPES = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
EMPTY = hashlib.sha256(b"").hexdigest()


def legal(initials):
    return initials == "" or initials.removeprefix("s") in {"ua" * n for n in range(1, 40)} if not initials.startswith("ss") else False


def cheapest(rows):
    """All edit sequences in turn: rows of (role, text, must_delete, truncated)."""
    best = [(4 * len(rows), "D" * len(rows), [])]

    def go(i, cost, audit, out):
        if cost > best[0][0]:
            return
        if i == len(rows):
            if legal("".join(r[:1] for r, _ in out)):
                best[0] = min(best[0], (cost, audit, out), key=lambda b: b[:2])
        else:
            role, text, must, cut = rows[i]
            go(i + 1, cost + 4, audit + "D", out)
            if not must:
                if role[:1] in ("s", "u", "a"):
                    go(i + 1, cost + 3 * cut, audit + "K", out + [(role, text)])
                for r in ("user", "assistant"):
                    go(i + 1, cost + 3 + 3 * cut, audit + "R", out + [(r, text)])
        for r in ("user", "assistant"):
            go(i, cost + 3, audit + "I", out + [(r, "")])

    go(0, 0, "", [])
    return best[0]


def sorted_rows(rows):
    named = [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in rows]
    return sorted(named, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def brute_report(rows):
    """The contract's columns from (conv_id, turn, role, text) after damage."""
    out = {}
    by_conv = defaultdict(list)
    for row in rows:
        by_conv[row[0]].append(row)
    for conv, group in by_conv.items():
        marked, seen = [], set()
        counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        ordered = sorted_rows(group)
        for _, role, text in ordered:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, *_ in ordered if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(ordered, ordered[1:]))
        cost, audit, repaired = cheapest(marked)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return out


def brute_damage(rows):
    kept = []
    for conv, turn, role, text in rows:
        spot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if spot == 1 else "".join(c for c in text if c not in ".!?") if spot == 2 else text
        kept += [(conv, turn, "user" if spot == 4 else role, text)] * {0: 0, 3: 2}.get(spot, 1)
    return kept


def random_rows(seed, convs=120):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "u2", "tool", "", None, "Über"]
    texts = ["Hi.", "Yes!", "No?", "cut", " ", "", None, "end.\n\t", "a", "\xa0", "Hi."]
    return [(None if c == 0 else c, rng.choice([None, *range(6)]) if rng.random() < 0.3 else i, rng.choice(roles), rng.choice(texts))
            for c in range(convs) for i in range(rng.randrange(6))]


def reports(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_report_is_that_of_all_edit_sequences(spark, seed):
    rows = random_rows(seed)
    assert reports(conversation_repair.repair_report(spark.createDataFrame(rows, TYPES).repartition(5))) == brute_report(rows)


def test_query_damages_and_repairs(spark, tmp_path):
    rows = random_rows(5, 200)
    spark.createDataFrame(rows, TYPES).write.parquet(str(tmp_path / "conversations.parquet"))
    got = reports(queries.op12_conversation_repair(spark, str(tmp_path)))
    want = brute_report(brute_damage(rows))
    assert got == {c: want.get(c, (0, 0, 0, 0, 0, 0, "", EMPTY)) for c in {r[0] for r in rows}}
    assert any(v[6] == "" and v[7] == EMPTY for v in got.values())


def test_repaired_rows_hash_to_the_report(spark):
    rows = random_rows(9)
    df = spark.createDataFrame(rows, TYPES)
    want = reports(conversation_repair.repair_report(df))
    edits = defaultdict(list)
    for r in conversation_repair.repaired_rows(df).collect():
        edits[r["conv_id"]].append(r)
    for conv, group in edits.items():
        group.sort(key=lambda r: r["step"])
        assert "".join(r["edit"] for r in group) == want[conv][6]
        lines = "\n".join(f"{r['role']}:{r['text']}" for r in group if r["edit"] != "D")
        assert hashlib.sha256(lines.encode()).hexdigest() == want[conv][7]


def test_well_formed_conversations_stay(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello!"), (2, 5, "user", "Hi."), (2, 7, "assistant", "Yes.")]
    got = reports(conversation_repair.repair_report(spark.createDataFrame(rows, TYPES)))
    assert [v[:7] for v in (got[1], got[2])] == [(0, 0, 0, 0, 0, 0, "KKK"), (1, 0, 0, 0, 0, 0, "KK")]


def test_very_long_conversation_is_read_in_bounded_memory(spark):
    n = 40 * FLUSH_ROWS
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Text {i}.") for i in range(n) if i % 1001]
    got = reports(conversation_repair.repair_report(spark.createDataFrame(rows, TYPES)))[1]
    assert got[:5] == (n - 2 - len(rows) + 1, 0, 0, 0, got[4]) and len(got[6]) >= len(rows)
    repair, open_rows = Repair(RoleGrammar()), 0
    for i in range(20_000):
        list(repair.read(i, "uuuaas"[i % 6], i % 97 == 0, i % 13 == 0))
        open_rows = max(open_rows, len(repair.steps))
    assert open_rows <= 3 * FLUSH_ROWS


def test_settling_and_dropping_tops_change_nothing():
    rng = random.Random(4)
    for _ in range(30):
        rows = [(rng.choice("usax"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(60)]
        told = []
        for flush, slack in ((1, None), (10_000, None), (10_000, 10**9)):
            r = Repair(RoleGrammar(slack=slack))
            r.flush_at = flush
            out = [e for i, (c, must, cut) in enumerate(rows) for e in r.read(i, c, must, cut)]
            out += list(r.finish())
            told.append((r.cost, out))
        assert told[0] == told[1] == told[2]


def test_automaton_accepts_the_role_language():
    grammar = RoleGrammar()
    rng = random.Random(2)
    for _ in range(3000):
        s = "".join(rng.choice("sua") for _ in range(rng.randrange(8)))
        stack = grammar.empty
        for c in s:
            stack = stack and grammar.shift(stack, c)
        assert bool(stack and grammar.accepts(stack)) == legal(s), s


def test_empty_table_and_extra_columns(spark):
    assert conversation_repair.repair_report(spark.createDataFrame([], TYPES)).count() == 0
    clash = spark.createDataFrame([(1, 0, "user", "Hi.", "x", "y", "z")], TYPES + ", fault string, audit string, cost string")
    assert reports(conversation_repair.repair_report(clash))[1][5:7] == (3, "KI")
