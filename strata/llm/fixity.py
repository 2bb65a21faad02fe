"""WARC Merkle fixity audit: compare two replicas of a record archive, find what differs.

A page is a WARC response record. Records lie in containers, ordered by (page_id,
url, digest), one after another: a record's range is its offset and length. Hash
tree of a container: a leaf hashes its record's SHA-256 with its offset range, a
node hashes up to ``fanout`` children in order with the range they cover, the root
covers the container. The audit compares container roots; below roots that differ
it compares nodes level by level and goes on only under those that differ; the
leaves reached are compared record by record.

All of it is DataFrame expressions.

Scale. Each replica is read once and its leaves and nodes are written (about 100
bytes a record, no payload). Roots are one row for ``records`` records; leaves
are read again only under differing nodes. A container holds the records of
``records`` consecutive page ids; equal records are one leaf with a count, and a
range of ids with more than ``4 * records`` distinct records is split by digest
into containers of about ``records``, so neither a repeated record nor a hot id
makes a large container.

Defined cases: a null id or url is the empty string, a null page is an empty
payload; rows that repeat a record count as copies of it and take that many
ranges; the copies of a key (id and url) with different payloads are told apart by
digest order; an empty replica has no containers; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import stage

RECORDS = 512
FANOUT = 16

_LEAF = ("container", "at", "page_id", "url", "nth", "copies", "length", "begin", "digest", "leaf")


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a page's WARC response record, as text."""
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), page_id,
                    F.lit(">\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "),
                    F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, html, F.lit("\r\n\r\n"))


def _entries(pages: DataFrame, records: int) -> DataFrame:
    """Distinct records with their number of copies, by range of ids."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("page_id", "url", "html")}
    whole = record(text["page_id"], text["url"], text["html"])
    ids = F.coalesce(F.expr(f"cast(floor(page_id / {int(records)}) AS string)"), F.lit("none"))
    return (pages.select(ids.alias("ids"), text["page_id"].alias("page_id"), text["url"].alias("url"),
                         F.sha2(whole, 256).alias("digest"), F.octet_length(whole).cast("long").alias("length"))
            .groupBy("ids", "page_id", "url", "digest", "length").agg(F.count("*").alias("copies")))


def leaves(entries: DataFrame, splits: DataFrame, records: int) -> DataFrame:
    """Leaves in container order; ``splits`` (ids, parts) says which ranges of ids are cut, and in how many."""
    part = F.when(F.col("parts").isNull(), F.lit("")).otherwise(F.concat(
        F.lit("/"), (F.conv(F.substring("digest", 1, 7), 16, 10).cast("long") % F.col("parts")).cast("string")))
    own = Window.partitionBy("container").orderBy(F.length("page_id"), "page_id", "url", "digest")
    same = Window.partitionBy("container", "page_id", "url").orderBy("digest")
    upto = F.sum(F.col("length") * F.col("copies")).over(own.rowsBetween(Window.unboundedPreceding, 0))
    return (entries.join(splits, "ids", "left").withColumn("container", F.concat("ids", part))
            .withColumn("at", F.row_number().over(own) - 1)
            .withColumn("nth", F.row_number().over(same))
            .withColumn("begin", upto - F.col("length") * F.col("copies"))
            .withColumn("leaf", F.sha2(F.concat_ws("|", "digest", F.col("begin").cast("string"),
                                                   F.col("length").cast("string"), F.col("copies").cast("string")), 256))
            .select(*_LEAF))


def _above(nodes: DataFrame, fanout: int, root: bool) -> DataFrame:
    """Parents of nodes (container, at, hash, begin, end)."""
    at = F.lit(0) if root else F.expr(f"at div {int(fanout)}").cast("int")
    child = F.array_sort(F.collect_list(F.struct("at", "hash", "begin", "end")))
    return (nodes.withColumn("up", at).groupBy("container", "up")
            .agg(child.alias("c"), F.min("begin").alias("begin"), F.max("end").alias("end"))
            .select("container", F.col("up").alias("at"), "begin", "end", F.sha2(F.array_join(F.transform(
                "c", lambda x: F.concat_ws("|", x["hash"], x["begin"].cast("string"), x["end"].cast("string"))),
                "\n"), 256).alias("hash")))


def tree(own: DataFrame, records: int, fanout: int) -> list[DataFrame]:
    """Levels of nodes from the leaves up; the last holds one root for each container."""
    level = stage(own.select("container", "at", F.col("leaf").alias("hash"), "begin",
                             (F.col("begin") + F.col("length") * F.col("copies")).alias("end")), "merkle")
    out, width = [level], 4 * records
    while width > fanout:
        out.append(stage(_above(out[-1], fanout, False), "merkle"))
        width = -(-width // fanout)
    return [*out, stage(_above(out[-1], fanout, True), "merkle")]


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(container, at) of nodes that only one side has or whose hashes differ."""
    x = a.select("container", "at", F.col("hash").alias("x"))
    y = b.select("container", "at", F.col("hash").alias("y"))
    return x.join(y, ["container", "at"], "full").filter(~F.col("x").eqNullSafe(F.col("y"))).select("container", "at")


def audit(reference: DataFrame, replica: DataFrame, records: int = RECORDS, fanout: int = FANOUT) -> DataFrame:
    """The records on which two replicas differ, with both ranges and digests.

    status: ``altered`` (other bytes), ``missing`` and ``extra`` (in one replica
    only), ``copies`` (another number of copies), ``moved`` (same bytes at another
    offset, behind one of the others). On a side without the record: begin -1, length
    and copies 0, an empty digest.
    """
    first, second = (stage(_entries(x, records), "records") for x in (reference, replica))
    # the side with more records in a range of ids decides its containers
    sizes = [x.groupBy("ids").agg(F.count("*").alias("n")) for x in (first, second)]
    splits = (sizes[0].unionByName(sizes[1]).groupBy("ids").agg(F.max("n").alias("n")).filter(F.col("n") > 4 * records)
              .select("ids", F.ceil(F.col("n") / records).cast("long").alias("parts")))
    a, b = (stage(leaves(x, splits, records), "leaves") for x in (first, second))
    up, down = tree(a, records, fanout), tree(b, records, fanout)
    wrong = stage(_differing(up[-1], down[-1]), "differing")
    for i in range(len(up) - 2, -1, -1):
        parent = F.lit(0) if i == len(up) - 2 else F.expr(f"at div {int(fanout)}").cast("int")
        sides = [x.withColumn("up", parent).join(wrong.select("container", F.col("at").alias("up")),
                                                 ["container", "up"], "left_semi") for x in (up[i], down[i])]
        wrong = stage(_differing(*sides), "differing")
    found = []
    for side, x in (("a", a), ("b", b)):
        own = x.join(wrong, ["container", "at"], "left_semi")
        found.append(own.select("container", "page_id", "url", "nth", *(F.col(c).alias(f"{c}_{side}") for c in (
            "begin", "length", "copies", "digest"))))
    pair = found[0].join(found[1], ["container", "page_id", "url", "nth"], "full")
    status = (F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra")
              .when(F.col("digest_a") != F.col("digest_b"), "altered")
              .when(F.col("copies_a") != F.col("copies_b"), "copies").otherwise("moved"))
    none = {"begin": F.lit(-1), "length": F.lit(0), "copies": F.lit(0), "digest": F.lit("")}
    return pair.select("container", "page_id", "url", F.col("nth").cast("long"), status.alias("status"),
                       *(F.coalesce(F.col(f"{c}_{s}"), v.cast("string" if c == "digest" else "long")).alias(f"{c}_{s}")
                         for c, v in none.items() for s in ("a", "b")))


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with faults that follow from the ids: lost, cut and altered records."""
    html = (F.when(F.col("page_id") % 307 == 11, F.expr("substring(html, 1, cast(length(html) div 2 AS int))"))
            .when(F.col("page_id") % 97 == 5, F.concat(F.lit("#"), F.expr("substring(html, 2)")))
            .otherwise(F.col("html")))
    lost = F.coalesce(F.col("page_id") % 1009 == 7, F.lit(False))
    return pages.filter(~lost).withColumn("html", html)


def oracle_sql(records: int = RECORDS) -> str:
    """The audit against ``damaged`` in DuckDB, record by record without a tree."""
    def side(name: str, source: str, splits: str) -> str:
        return f"""{name}_e AS (SELECT ids, page_id, url, sha256(rec) AS digest, octet_length(encode(rec))::BIGINT AS length,
  count(*) AS copies FROM (SELECT ids, page_id, url, 'WARC/1.1' || e || 'WARC-Type: response' || e ||
    'WARC-Record-ID: <urn:page:' || page_id || '>' || e || 'WARC-Target-URI: ' || url || e || 'Content-Length: '
    || octet_length(encode(html)) || e || e || html || e || e AS rec FROM (SELECT coalesce(floor(page_id / {records})::BIGINT::VARCHAR,
    'none') AS ids, coalesce(page_id::VARCHAR, '') AS page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
    chr(13) || chr(10) AS e FROM {source})) GROUP BY ALL),
{splits}
{name}_c AS (SELECT *, ids || CASE WHEN parts IS NULL THEN '' ELSE '/' || (('0x' || digest[1:7])::BIGINT % parts) END AS container
  FROM {name}_e LEFT JOIN splits USING (ids)),
{name} AS (SELECT container, page_id, url, digest, length, copies,
  row_number() OVER (PARTITION BY container ORDER BY length(page_id), page_id, url, digest) - 1 AS pos,
  row_number() OVER (PARTITION BY container, page_id, url ORDER BY digest) AS nth,
  (sum(length * copies) OVER (PARTITION BY container ORDER BY length(page_id), page_id, url, digest)
    - length * copies)::BIGINT AS begin_at FROM {name}_c)"""

    cut = f"""splits AS (SELECT ids, ceil(count(*) / {records})::BIGINT AS parts FROM a_e GROUP BY ids
  HAVING count(*) > {4 * records}),"""
    hurt = """(SELECT page_id, url, CASE WHEN page_id % 307 = 11 THEN substring(html, 1, (length(html) // 2)::INT)
      WHEN page_id % 97 = 5 THEN '#' || substring(html, 2) ELSE html END AS html
      FROM pages WHERE NOT coalesce(page_id % 1009 = 7, false))"""
    return f"""WITH {side('a', 'pages', cut)},
{side('b', hurt, '')},
wrong AS (SELECT container, pos FROM a FULL JOIN b USING (container, pos)
  WHERE (a.digest, a.begin_at, a.length, a.copies) IS DISTINCT FROM (b.digest, b.begin_at, b.length, b.copies)),
x AS (SELECT * FROM a SEMI JOIN wrong USING (container, pos)), y AS (SELECT * FROM b SEMI JOIN wrong USING (container, pos))
SELECT container, page_id, url, nth, CASE WHEN y.digest IS NULL THEN 'missing' WHEN x.digest IS NULL THEN 'extra'
  WHEN x.digest <> y.digest THEN 'altered' WHEN x.copies <> y.copies THEN 'copies' ELSE 'moved' END AS status,
  coalesce(x.begin_at, -1) AS begin_a, coalesce(y.begin_at, -1) AS begin_b, coalesce(x.length, 0) AS length_a,
  coalesce(y.length, 0) AS length_b, coalesce(x.copies, 0) AS copies_a, coalesce(y.copies, 0) AS copies_b,
  coalesce(x.digest, '') AS digest_a, coalesce(y.digest, '') AS digest_b
FROM x FULL JOIN y USING (container, page_id, url, nth)"""
