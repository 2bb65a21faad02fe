"""Conversation structure repair: the cheapest edits that make a conversation legal, by auction.

A conversation's roles are legal if their initials read ``(s?(ua)+)?``. Its rows, in
order, and the four states of that pattern make a lattice: node (i, q) stands before
row i in state q. Arcs: Keep a row whose initial the state allows (0), Rerole it to the
user or assistant that the state asks for (3), Delete it (4; the only arc of a blank row or a duplicate), Insert an
empty text of the role asked for (3). A truncated row that is not deleted adds 3.

Auction. Nodes have prices, at first 0, never above the cost of an arc plus its end's
price. From an origin a path grows: its last node is raised to the least cost plus price
over its arcs; if that was its price already, the path extends along that arc, else the
path contracts by that node. A path that reaches the end, or a node on an earlier path that
did, leaves all its nodes with their true distances. Origins are taken from the last row
to the first and prices are kept, so each path is short. At the end every node's price is its distance, and
the arcs whose cost plus price makes up the price of their start (tight) are exactly those of cheapest
paths. From the start the tight arc with the least letter (D, I, K, R) is followed: a letter
determines the next node, so this is the ASCII-least audit of all cheapest ones.

Long conversations. Rows are put in order by one range-partitioned sort, whatever
conversation they are of, and numbered by it. ``SEGMENT`` numbers make a segment. A conversation in several
segments has a price matrix for each (an auction for each state it can end in),
whose products from the last to the first give the prices at the end of each; every segment
is then solved on its own for the four states it can begin in, and the states are followed through.
So no conversation's rows are in one task, whatever share of the table it holds, until the digest: SHA-256 of
a conversation's repaired text reads it in order, streamed, with one line in memory.

Defined cases: null role, text, id and turn read as one space in the damage's key and in the text; rows with
equal turns go by role, then the first 64 characters, then a digest of role and text; rows without an id are one conversation;
repeated rows are duplicates; roles with other initials, or none, can only be reroled or deleted; a conversation whose rows are all gone
has zeros and no audit; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: rows of a segment, as a power of two
SEGMENT = 14
DAMAGE = 20
_NONE = 1 << 60

# states: nothing yet, after system, after user, after assistant; what each asks for and where that leads
_ASKED = (("u", 2), ("u", 2), ("a", 3), ("u", 2))
_ROLES = {"u": "user", "a": "assistant"}
#: prices at the end of a conversation: the inserts that complete it
_END = (0, REROLE + INSERT, INSERT, 0)
_TAILS = ("", "ua", "a", "")
#: a row's code: initial (s, u, a, other) by state of the text (whole, to be deleted, truncated)
_CODES = "ABCDEFGHIJKL"


def _arcs(code: str, q: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, rows consumed, next state) of the arcs of a node before a row of this code."""
    initial, fault = divmod(_CODES.index(code), 3)
    role, there = _ASKED[q]
    arcs = [("D", DELETE, 1, q), ("I", INSERT, 0, there)]
    if fault != 1:
        more = TRUNCATED if fault == 2 else 0
        if "sua"[initial:initial + 1] == role:
            arcs.append(("K", KEEP + more, 1, there))
        if initial == 0 and q == 0:
            arcs.append(("K", KEEP + more, 1, 1))
        arcs.append(("R", REROLE + more, 1, there))
    return arcs


_ARCS = {c: [_arcs(c, q) for q in range(4)] for c in _CODES}


def auction(codes: str, ends: tuple[int, ...]) -> list[int]:
    """Prices of nodes 4 * i + q: their least cost to the nodes behind the last row, whose prices are ``ends``."""
    n = len(codes)
    price = [0] * (4 * n) + list(ends)
    settled = [False] * (4 * n) + [True] * 4
    if min(ends[2:]) >= _NONE:                     # after a user's row there are only these two states: no way to the end
        for node in range(4 * n):
            if node % 4 > 1:
                price[node], settled[node] = _NONE, True
    for origin in range(4 * n - 1, -1, -1):
        path = [origin]
        while path:
            node = path[-1]
            if settled[node]:
                break
            i, q = divmod(node, 4)
            best, to = _NONE, -1
            for _, cost, step, there in _ARCS[codes[i]][q]:
                other = 4 * (i + step) + there
                if cost + price[other] < best:
                    best, to = cost + price[other], other
            if best >= _NONE:                      # no way to the end from here
                price[node], settled[node] = _NONE, True
                path.pop()
            elif price[node] < best:               # contract
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:                                  # extend
                path.append(to)
        for node in path:
            settled[node] = True
    return price


def traced(codes: str, price: list[int], q: int) -> tuple[str, int]:
    """The least letters along tight arcs from state ``q``, and the state they lead to."""
    out, i = [], 0
    while i < len(codes):
        for letter, cost, step, there in _ARCS[codes[i]][q]:       # in the order of the letters
            if cost + price[4 * (i + step) + there] == price[4 * i + q]:
                out.append(letter)
                i, q = i + step, there
                break
    return "".join(out), q


@lru_cache(maxsize=4096)
def _solved_short(codes: str) -> tuple[int, str, int]:
    price = auction(codes, _END)
    return price[0], *traced(codes, price, 0)


def solved(codes: str) -> tuple[int, str, int]:
    """Cost, audit without the last inserts, and last state of a whole conversation."""
    return _solved_short(codes) if len(codes) <= 64 else _solved_short.__wrapped__(codes)


def edits(codes: str, audit: str, q: int) -> Iterator[tuple[str, str]]:
    """Per row the roles inserted before it, and what becomes of it: d, k, or its new role's initial."""
    before, at = "", 0
    for letter in audit:
        role, there = _ASKED[q]
        if letter == "I":
            before, q = before + role, there
            continue
        if letter == "R":
            q = there
        elif letter == "K":
            q = 1 if _CODES.index(codes[at]) < 3 else there
        yield before, {"D": "d", "K": "k"}.get(letter, role)
        before, at = "", at + 1


# --- rows ------------------------------------------------------------------------------------

def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after the contract's damage: key, conv_id, turn, role, text."""
    hit = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn"))) % DAMAGE
    own = rows.select(_key().alias("key"), "conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), hit.alias("hit"))
    return (own.filter("hit <> 0")
            .withColumn("text", F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", ""))
                        .otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")))
            .withColumn("again", F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("key", "conv_id", "turn", "role", "text"))


def _key() -> Column:
    """A conversation's name, one of its own for rows without an id."""
    return F.coalesce(F.concat(F.lit("k"), F.col("conv_id").cast("string")), F.lit(" "))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows numbered in the order of (conversation, turn): pos ascends along the sorted ranges."""
    sized = rows.select("key", "turn", "role", "text", F.substring("text", 1, 64).alias("head"),
                        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("sha"),
                        F.monotonically_increasing_id().alias("tie"))
    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("sha"), F.col("tie")]
    return stage(sized.repartitionByRange(*order).sortWithinPartitions(*order)
                 .select("key", F.monotonically_increasing_id().alias("pos"), "turn", "role", "text", "sha"), "turns")


def _coded(ordered: DataFrame) -> DataFrame:
    """(key, pos, code, blank, duplicate, truncated): a row's first fault and its initial."""
    seen = ordered.groupBy("key", "sha").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    marked = (ordered.select("key", "pos", F.substring("role", 1, 1).alias("initial"), last.alias("last"))
              .join(seen, "pos", "left"))
    blank = F.col("last") == ""
    duplicate = ~blank & F.col("first").isNull()
    cut = ~blank & ~duplicate & ~F.col("last").isin(".", "!", "?")
    kind = F.when(blank | duplicate, F.lit(1)).when(cut, F.lit(2)).otherwise(F.lit(0))
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    return marked.select("key", "pos", F.substring(F.lit(_CODES), initial * 3 + kind + 1, F.lit(1)).alias("code"),
                         blank.alias("blank"), duplicate.alias("duplicate"), cut.alias("truncated"))


def _illegal(codes: str) -> int:
    """Adjacent rows whose initials are not su, ua or au."""
    kinds = ["suax"[_CODES.index(c) // 3] for c in codes]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))


# --- tasks -------------------------------------------------------------------------------------

def _rows(batches: Iterator[pa.RecordBatch], make, schema: str, types: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    """The rows that ``make`` yields for each input row, as batches."""
    out = []
    for batch in batches:
        for row in batch.to_pylist():
            out.extend(make(row))
            while len(out) >= size:
                yield pa.RecordBatch.from_pylist(out[:size], types)
                out = out[size:]
    if out:
        yield pa.RecordBatch.from_pylist(out, types)


def _mapped(df: DataFrame, make, schema: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    types = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(lambda batches: _rows(batches, make, schema, types), schema)


def _matrix(row):
    """Least costs of a segment from each state to each, one auction for each end."""
    ends = [tuple(0 if t == q else _NONE for t in range(4)) for q in range(4)]
    prices = [auction(row["codes"], e)[:4] for e in ends]
    yield {"key": row["key"], "seg": row["seg"], "cost": [prices[t][s] for s in range(4) for t in range(4)]}


def _end_prices(row):
    """Prices behind every segment of a conversation, from its last to its first."""
    now = list(_END)
    for part in reversed(row["parts"]):
        yield {"key": row["key"], "seg": part["seg"], "ends": now}
        now = [min(min(part["cost"][4 * s + t] + now[t], _NONE) for t in range(4)) for s in range(4)]


def _solve(row):
    """A segment's audits: of a whole conversation one, else one for each state to begin in."""
    codes = row["codes"]
    if row["ends"] is None:
        cost, audit, q = solved(codes)
        found = [(cost, audit, q)]
    else:
        price = auction(codes, tuple(row["ends"]))
        found = [(price[q], *traced(codes, price, q)) for q in range(4)]
    yield {"key": row["key"], "seg": row["seg"], "base": row["base"], "codes": codes, "illegal": _illegal(codes),
           "costs": [f[0] for f in found], "audits": [f[1] for f in found], "leads": [f[2] for f in found]}


def _followed(row):
    """The state in which each segment of a conversation begins, and the illegal pairs across segments."""
    q, before = 0, None
    for part in row["parts"]:
        across = 0 if before is None else _illegal(before + part["first"])
        yield {"key": row["key"], "seg": part["seg"], "q": q, "across": across, "ends_here": part["seg"] == row["parts"][-1]["seg"]}
        q, before = part["leads"][q], part["last"]


def _changes(row):
    """Rows that do not simply stay, with what is inserted before them, and the inserts at the end."""
    codes, q = row["codes"], row["q"]
    n = 0
    for before, what in edits(codes, row["audit"], q):
        if before or what != "k":
            yield {"key": row["key"], "pos": row["base"] + n, "rank": 0, "roles": before, "what": what}
        n += 1
    if row["ends_here"] and _TAILS[row["lead"]]:
        yield {"key": row["key"], "pos": row["base"] + n - 1, "rank": 2, "roles": _TAILS[row["lead"]], "what": None}


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and changes in order to one digest of the repaired text a conversation."""
    key, sha, first, change = None, None, True, None

    def line(role: str, text: str):
        nonlocal first
        if not first:
            sha.update(b"\n")
        sha.update(f"{role}:{text}".encode())
        first = False

    done = []
    for batch in batches:
        for row in batch.to_pylist():
            if row["key"] != key:
                if key is not None:
                    done.append((key, sha.hexdigest()))
                key, sha, first, change = row["key"], hashlib.sha256(), True, None
            if row["rank"] != 1:
                for r in row["roles"]:
                    line(_ROLES[r], "")
                change = row["what"] if row["rank"] == 0 else None
                continue
            if change != "d":
                line(_ROLES.get(change, row["role"]), row["text"])
            change = None
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done)], ["key", "repaired_sha256"])
            done = []
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([sha.hexdigest()])], ["key", "repaired_sha256"])


def _parts(df: DataFrame, *columns: str) -> DataFrame:
    """Per conversation its segments in order: a segment's figures, never its rows."""
    return df.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("seg", *columns))).alias("parts"))


def repair(rows: DataFrame, conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``conversations`` (conv_id), from its ``rows`` (key, turn, role, text as ``damaged`` gives them)."""
    ordered = _ordered(rows)
    coded = stage(_coded(ordered), "codes")
    segs = stage(coded.groupBy("key", F.shiftright("pos", segment).alias("seg"))
                 .agg(F.min("pos").alias("base"), F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("c"))
                 .select("key", "seg", "base", F.array_join(F.transform("c", lambda x: x["code"]), "").alias("codes")), "segments")
    long = segs.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    costs = _mapped(segs.join(long, "key", "left_semi").select("key", "seg", "codes"), _matrix, "key string, seg long, cost array<long>")
    ends = _mapped(_parts(costs, "cost"), _end_prices, "key string, seg long, ends array<long>")
    found = stage(_mapped(segs.join(ends, ["key", "seg"], "left"), _solve,
                          "key string, seg long, base long, codes string, illegal long, costs array<long>, audits array<string>, "
                          "leads array<int>"), "audits")
    many = found.filter(F.size("audits") > 1).select(
        "key", "seg", "leads", F.substring("codes", 1, 1).alias("first"), F.expr("right(codes, 1)").alias("last"))
    begun = _mapped(_parts(many, "leads", "first", "last"), _followed, "key string, seg long, q int, across long, ends_here boolean")
    q = F.coalesce(F.col("q"), F.lit(0))
    chosen = stage(found.join(begun, ["key", "seg"], "left").select(
        "key", "seg", "base", "codes", q.alias("q"), F.col("audits")[q].alias("audit"), F.col("leads")[q].alias("lead"),
        F.col("costs")[q].alias("cost"), (F.col("illegal") + F.coalesce("across", F.lit(0))).alias("illegal"),
        F.coalesce("ends_here", F.lit(True)).alias("ends_here")), "chosen")
    tail = F.when(F.col("ends_here") & (F.col("lead") == 1), F.lit("II")).when(F.col("ends_here") & (F.col("lead") == 2), F.lit("I")).otherwise(F.lit(""))
    audits = chosen.groupBy("key").agg(
        F.sum("illegal").alias("illegal"), F.min(F.struct("seg", "cost"))["cost"].alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", F.concat("audit", tail).alias("a")))), lambda x: x["a"]), "").alias("audit"))
    faults = coded.groupBy("key").agg(*(F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")))
    gaps = rows.groupBy("key").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    changes = _mapped(chosen.select("key", "base", "codes", "q", "audit", "lead", "ends_here"), _changes,
                      "key string, pos long, rank int, roles string, what string")
    lines = (ordered.select("key", "pos", F.lit(1).alias("rank"), "role", "text").unionByName(changes, allowMissingColumns=True)
             .select("key", "pos", "rank", "role", "text", "roles", "what").repartition("key").sortWithinPartitions("key", "pos", "rank"))
    digests = lines.mapInArrow(_digests, "key string, repaired_sha256 string")
    out = conversations.select("conv_id").distinct().withColumn("key", _key())
    for part in (gaps, faults, audits, digests):
        out = out.join(part, "key", "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
