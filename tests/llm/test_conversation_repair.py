"""Conversation repair against an exhaustive search over edits, written apart from the lattice."""
import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from strata.llm import conversation_repair as cr

ROWS = "conv_id long, turn long, role string, text string"


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


def order(r):
    sha = hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
    return (r[1] is not None, r[1] or 0, r[2].encode(), r[3][:64].encode(), sha)


def cheapest(rows):
    """(cost, audit, lines) by trying every edit; rows are (role, text, fault)."""
    legal = re.compile("(s?(ua)+)?")

    def grows(s):          # s can go on to a legal string
        return any(legal.fullmatch(s + t) for t in ("", "a", "ua"))

    @lru_cache(None)
    def best(i, tail, inserted):
        """Cheapest from row i; of the emitted initials only the last two matter."""
        found = []
        if i == len(rows) and legal.fullmatch(tail):
            found.append((0, "", ()))
        moves = []
        if inserted < 3:
            moves += [(3, "I", i, c, f"{n}:") for c, n in (("u", "user"), ("a", "assistant"))]
        if i < len(rows):
            role, text, fault = rows[i]
            moves.append((4, "D", i + 1, "", None))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role:            # an empty role has no initial to keep
                    moves.append((more, "K", i + 1, role[:1], f"{role}:{text}"))
                moves += [(3 + more, "R", i + 1, c, f"{n}:{text}") for c, n in (("u", "user"), ("a", "assistant"))]
        for cost, letter, to, c, line in moves:
            now = tail + c
            if c and not grows(now):
                continue
            if now.endswith("ua") and len(now) > 2:      # all legal strings that end so go on alike
                now = "ua"
            if now == "su" or now == "uau":
                now = "u"
            rest = best(to, now, inserted + 1 if letter == "I" else 0)
            if rest:
                found.append((cost + rest[0], letter + rest[1], ((line,) if line is not None else ()) + rest[2]))
        return min(found, default=None)
    return best(0, "", 0)


def expected(rows):
    out = {}
    damaged = after_damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged if r[0] == conv), key=order)
        turns = [r[1] for r in own if r[1] is not None]
        seen, marked, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for _, _, role, text in own:
            last = re.search(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z", text)
            fault = ("blank" if not last else "duplicate" if (role, text) in seen else
                     "truncated" if last[1] not in ".!?" else "")
            seen.add((role, text))
            count[fault] += 1
            marked.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = cheapest(marked)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count["blank"], count["duplicate"],
                     count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, ROWS)
    got = cr.repair(cr.damaged(df), df, **options).collect()
    have = {r.conv_id: tuple(r)[1:] for r in got}
    assert len(got) == len(have)
    assert have == expected(rows)


def some_rows(seed, conversations, longest):
    rnd = random.Random(seed)
    texts = ["A b.", "c d", "", " \t", "e!", "f? ", "g.\n", "h \x0b", None, "i."]
    rows = []
    for c in range(conversations):
        for t in range(rnd.randint(1, longest)):
            rows.append((None if c == 0 else c, None if rnd.random() < 0.05 else rnd.randint(0, 2 * longest) if rnd.random() < 0.2 else t,
                         rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]), rnd.choice(texts) if rnd.random() < 0.5
                         else f"text {rnd.randint(0, 99)}{rnd.choice(['.', '?', ''])}"))
    return rows


def test_against_exhaustive_search(spark):
    check(spark, some_rows(1, 120, 9))


def test_long_conversations_go_in_segments(spark):
    rows = some_rows(2, 3, 60) + some_rows(3, 20, 5)
    check(spark, [(r[0] + 100 if r[0] and i > 60 else r[0], *r[1:]) for i, r in enumerate(rows)], segment=2)


def test_segments_do_not_matter_to_the_auction():
    rnd = random.Random(4)
    for _ in range(200):
        codes = "".join(rnd.choice(cr._CODES) for _ in range(rnd.randint(1, 24)))
        whole = cr.solved(codes)
        cut = rnd.randint(0, len(codes))
        ends = cr.auction(codes[cut:], cr._END)[:4]
        head = cr.auction(codes[:cut], tuple(ends))
        a, q = cr.traced(codes[:cut], head, 0)
        b, q = cr.traced(codes[cut:], cr.auction(codes[cut:], cr._END), q)
        assert (head[0], a + b, q) == whole


def test_all_rows_dropped_and_empty_table(spark):
    gone = [(c, t, "user", "x.") for c in range(400) for t in [0] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    check(spark, gone)
    empty = spark.createDataFrame([], ROWS)
    assert cr.repair(cr.damaged(empty), empty).collect() == []


def test_repeated_rows_extra_columns_and_text_ids(spark):
    rows = [("a b", 0, "user", "x."), ("a b", 0, "user", "x."), ("a b", 1, "assistant", "y."), (None, 1, "user", "z" * 300000)]
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], ROWS.replace("conv_id long", "conv_id string") + ", key int, seg string, pos int")
    got = {r.conv_id: tuple(r)[1:] for r in cr.repair(cr.damaged(df), df).collect()}
    assert got == expected(rows)


@pytest.mark.parametrize("share", [0.34])
def test_one_conversation_with_a_third_of_all_rows(spark, share):
    rows = [(7, t, ("user", "assistant")[t % 2], f"line {t}.") for t in range(200)] + some_rows(5, 80, 6)
    df = spark.createDataFrame(rows, ROWS)
    got = {r.conv_id: r for r in cr.repair(cr.damaged(df), df, segment=4).collect()}
    own = [r for r in rows if r[0] == 7]
    whole = {r.conv_id: r for r in cr.repair(cr.damaged(df), df).collect()}
    assert got == whole and len(got[7].audit) >= 0.8 * len(own)
