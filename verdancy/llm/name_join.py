"""Edit-distance join of names: trie descent with dynamic-programming rows, in shards by length.

Distance is the unrestricted Damerau-Levenshtein distance over code points: the
fewest insertions, deletions, substitutions and exchanges of two adjacent code
points, where what has been exchanged may be edited again.

Method.  Rows are first summed up to distinct *forms*, so copies of a name are
compared once.  The forms of the dictionary side are sharded by their length L.
A length is one of few values and may hold a third of all names, so its shard is
cut further: a form is split into 2k + 1 segments (k is the largest distance).
One operation touches two neighbouring segments at most, so of any pair within
distance k a segment is untouched, and stands in the other name shifted by at
most k.  A shard is one (L, segment, its text); a query goes to the shards of
its own substrings at the shifts that L and k allow.  Shards of more than
``CHUNK`` forms or queries are dealt as a grid of chunks.  A pair is taken in
the first segment that matches, so it comes up once.

In a chunk the forms become a trie, and each query descends it depth first.  The
row of a node is computed from its parent's, once for all forms below it; only
the 2k + 1 cells about the diagonal can be within k.  An exchange with edits in
between reads an earlier row, so the last k + 1 rows of the path are retained.
A subtree is left when no live row can still lead to k: the newest row's least
cell and those of the retained rows plus their age all exceed k.

Nothing is broadcast or collected (joins are hinted to shuffle, whatever the
size, and adaptive execution splits their hot keys); the totals of a query are summed in the
tasks and then by a partial aggregation.

Edge cases.  Null names, and names that are empty once normalised, take no part.
Rows without an id count (their id adds nothing to first and crc; a misspelling
needs an id, so such a vendor's name stays as stored).  Rows that repeat an id
are rows of their own on both sides.  Names shorter than 2k + 1 share a shard of
their length.  Empty tables give no rows.  Only the id and name columns are read,
so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, saved

MAX_DISTANCE = 1
#: Forms, and queries, of one chunk of a shard: a figure of balance, not of results.
CHUNK = 512
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SHARD = ["length", "segment", "piece"]


def normalised(name: Column) -> Column:
    """A-Z in lower case and without white space; null if nothing is left."""
    form = F.regexp_replace(F.translate(name, _UPPER, _LOWER), r"[\x20\x09-\x0D]", "")
    return F.when(form != "", form)


def id_crc(column: str) -> Column:
    return F.crc32(F.col(f"`{column}`").cast("string").cast("binary"))


def misspelt(name: str, by: str) -> Column:
    """The name with two neighbours exchanged where the crc32 of its id is even, at the place that it names."""
    text, h = F.col(f"`{name}`"), id_crc(by)
    at = F.pmod(h, F.greatest(F.char_length(text) - 1, F.lit(1))).cast("int")
    swapped = F.concat(F.substring(text, F.lit(1), at), F.substring(text, at + 2, F.lit(1)), F.substring(text, at + 1, F.lit(1)), F.substring(text, at + 3, F.char_length(text)))
    return F.when((F.pmod(h, F.lit(2)) == 0) & (F.char_length(text) >= 2), swapped).otherwise(text)


def segments(length: int, k: int) -> list[tuple[int, int]]:
    """(begin, end) of the segments of a form of that length; short forms have one empty segment."""
    n = 2 * k + 1
    return [(s * length // n, (s + 1) * length // n) for s in range(n)] if length >= n else [(0, 0)]


def shifts(longer: int, k: int) -> list[int]:
    """Where a segment of a form can stand in a query that is longer by so much: at most k insertions and deletions in all."""
    return [x for x in range(-k, k + 1) if abs(x) + abs(longer - x) <= k]


def first_segment(form: str, query: str, k: int) -> int:
    """The first segment of form that query holds at an allowed shift, or -1."""
    for s, (a, b) in enumerate(segments(len(form), k)):
        for x in shifts(len(query) - len(form), k):
            if a + x >= 0 and b + x <= len(query) and form[a:b] == query[a + x : b + x]:
                return s
    return -1


def _segment_rows(k: int) -> tuple[Column, Column]:
    """begin and end of the segment column for the length column."""
    n = 2 * k + 1
    whole = F.col("length") >= n
    bound = lambda s: F.when(whole, F.floor(s * F.col("length") / n)).otherwise(0).cast("int")
    return bound(F.col("segment")), bound(F.col("segment") + 1)


def _keys_of_forms(forms: DataFrame, k: int) -> DataFrame:
    """A row for each segment of each form."""
    rows = forms.withColumn("length", F.char_length("form")).withColumn("segment", F.explode(F.array(*[F.lit(s) for s in range(2 * k + 1)])))
    rows = rows.where((F.col("length") >= 2 * k + 1) | (F.col("segment") == 0))
    begin, end = _segment_rows(k)
    return rows.withColumn("piece", F.substring("form", begin + 1, end - begin))


def _keys_of_queries(queries: DataFrame, k: int) -> DataFrame:
    """A row for each shard that a query has to visit; a shard can come up twice where a query repeats itself."""
    places = [(longer, s, x) for longer in range(-k, k + 1) for s in range(2 * k + 1) for x in shifts(longer, k)]
    at = F.explode(F.array(*[F.struct(F.lit(d).alias("longer"), F.lit(s).alias("segment"), F.lit(x).alias("shift")) for d, s, x in places]))
    rows = queries.withColumn("at", at).select("form", F.col("at.segment").alias("segment"), F.col("at.shift").alias("shift"), (F.char_length("form") - F.col("at.longer")).alias("length"))
    rows = rows.where((F.col("length") >= 2 * k + 1) | ((F.col("segment") == 0) & (F.col("length") > 0)))
    begin, end = _segment_rows(k)
    rows = rows.withColumn("begin", begin + F.col("shift")).withColumn("end", end + F.col("shift"))
    rows = rows.where((F.col("begin") >= 0) & (F.col("end") <= F.char_length("form")) | (F.col("length") < 2 * k + 1))
    return rows.withColumn("piece", F.when(F.col("end") > F.col("begin"), F.substring("form", F.col("begin") + 1, F.col("end") - F.col("begin"))).otherwise("")).select("form", *_SHARD)


class _Node(dict):
    """Children by code point; form is the number of the form that ends here."""

    __slots__ = ("form",)

    def __init__(self):
        self.form = -1


def trie_of(forms: list[str]) -> _Node:
    root = _Node()
    for number, form in enumerate(forms):
        node = root
        for c in form:
            node = node[c] if c in node else node.setdefault(c, _Node())
        node.form = number
    return root


def _next_row(query: str, i: int, path: str, rows: tuple, k: int) -> list[int]:
    """Row i of the trie path whose last code point is path[-1].

    Cell t of a row is the distance of the path's first i code points and the
    query's first i - k + t.  rows are the last rows before it, path their code
    points with the new one, both newest last.
    """
    far, m, c = k + 1, len(query), path[-1]
    above, row = rows[-1], []
    for t in range(2 * k + 1):
        j = i - k + t
        if j < 0 or j > m:
            row.append(far)
            continue
        least = above[t + 1] + 1 if t < 2 * k else far
        if j:
            x = query[j - 1]
            least = min(least, above[t] + (x != c), row[t - 1] + 1 if t else far)
            if x != c:
                # the last place of c in the query before j, and of x in the path before i: what lies between is deleted or inserted
                for b in range(2, min(k + 1, j) + 1):
                    if query[j - b] == c:
                        for a in range(2, min(k + 1, len(path)) + 1):
                            if path[-a] == x:
                                cell = (j - b) - (i - a) + k
                                if 0 <= cell <= 2 * k and a <= len(rows):
                                    least = min(least, rows[-a][cell] + a + b - 3)
                                break
                        break
        row.append(min(least, far))
    return row


def descend(root: _Node, query: str, k: int) -> Iterator[tuple[int, int]]:
    """(number of a form, distance) of every form of the trie within distance k of the query."""
    m, far = len(query), k + 1
    first = [t - k if 0 <= t - k <= m else far for t in range(2 * k + 1)]
    stack = [(root, 0, "", (first,))]
    while stack:
        node, i, path, rows = stack.pop()
        if node.form >= 0 and 0 <= m - i + k <= 2 * k and rows[-1][m - i + k] <= k:
            yield node.form, rows[-1][m - i + k]
        if all(min(row) + age > k for age, row in enumerate(reversed(rows))):
            continue
        for c, child in node.items():
            now = (path + c)[-k - 1 :]
            stack.append((child, i + 1, now, (*rows, _next_row(query, i + 1, now, rows, k))[-k - 1 :]))


def _chunks(k: int, of_chunk: Callable[[list[tuple], list[str], int, int], Iterator[tuple]], schema: pa.Schema):
    """Rows sorted by chunk, then forms before queries; of_chunk gives the result rows of one chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, forms, queries, out = None, [], [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*_SHARD, "form_chunk", "query_chunk", "side", "form", "n", "first", "crc")]
            for length, segment, piece, a, b, side, form, *rest in zip(*columns):
                if (length, segment, piece, a, b) != now:
                    if queries and forms:
                        out += of_chunk(forms, queries, now[1], k)
                    now, forms, queries = (length, segment, piece, a, b), [], []
                if side == 0:
                    forms.append((form, *rest))
                elif not queries or queries[-1] != form:
                    queries.append(form)
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)
                out = []
        if queries and forms:
            out += of_chunk(forms, queries, now[1], k)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)

    return run


def _matches(forms: list[tuple], query: str, root: _Node, segment: int, k: int) -> Iterator[tuple[int, int]]:
    for number, distance in descend(root, query, k):
        if first_segment(forms[number][0], query, k) == segment:
            yield number, distance


def _pairs(forms: list[tuple], queries: list[str], segment: int, k: int) -> Iterator[tuple]:
    root = trie_of([f[0] for f in forms])
    for query in queries:
        for number, distance in _matches(forms, query, root, segment, k):
            yield query, forms[number][0], distance


def _totals(forms: list[tuple], queries: list[str], segment: int, k: int) -> Iterator[tuple]:
    """For each query and distance what its forms add up to."""
    root = trie_of([f[0] for f in forms])
    for query in queries:
        found: dict[int, list] = {}
        for number, distance in _matches(forms, query, root, segment, k):
            _, n, first, crc = forms[number]
            have = found.setdefault(distance, [0, None, 0])
            have[0] += n
            have[1] = first if have[1] is None else have[1] if first is None else min(first, have[1])
            have[2] += crc or 0
        for distance, have in found.items():
            yield query, distance, *have


_PAIR = pa.schema([("query", pa.string()), ("form", pa.string()), ("distance", pa.int32())])
_TOTAL = pa.schema([("form", pa.string()), ("distance", pa.int32()), ("n", pa.int64()), ("first", pa.int64()), ("crc", pa.int64())])


def _dealt(forms: DataFrame, queries: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """The rows of both sides in their chunks, one partition a chunk, forms before queries and each in order."""
    own, asked = _keys_of_forms(forms, k), _keys_of_queries(queries, k)
    count = lambda rows, name: rows.groupBy(*_SHARD).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias(name))
    shards = scratch.saved(count(own, "form_chunks").join(count(asked, "query_chunks").hint("merge"), _SHARD), "shards").hint("merge")
    dealt = lambda column, n: F.pmod(F.xxhash64(column), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = own.join(shards, _SHARD).withColumn("form_chunk", dealt("form", "form_chunks")).withColumn("query_chunk", spread("query_chunks"))
    right = asked.join(shards, _SHARD).withColumn("query_chunk", dealt("form", "query_chunks")).withColumn("form_chunk", spread("form_chunks"))
    columns = [*_SHARD, "form_chunk", "query_chunk"]
    none = F.lit(None).cast("long")
    rows = left.select(*columns, F.lit(0).alias("side"), "form", "n", "first", "crc").unionByName(right.select(*columns, F.lit(1).alias("side"), "form", none.alias("n"), none.alias("first"), none.alias("crc")))
    return rows.repartition(*columns).sortWithinPartitions(*columns, "side", "form")


def _forms(names: DataFrame, column: str, by: str) -> DataFrame:
    """(form, n, first, crc) of the distinct forms: how many rows have it, their smallest id and the sum of their ids' crc32."""
    named = names.select(normalised(F.col(f"`{column}`")).alias("form"), F.col(f"`{by}`").cast("long").alias("id"), id_crc(by).alias("crc")).where("form is not null")
    return named.groupBy("form").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.coalesce(F.sum("crc"), F.lit(0)).alias("crc"))


def name_pairs(forms: DataFrame, queries: DataFrame, k: int = MAX_DISTANCE) -> DataFrame:
    """(query, form, distance) of the distinct texts of forms(form) and queries(form) within distance k."""
    none = F.lit(None).cast("long")
    with Scratch(forms.sparkSession) as scratch:
        own = scratch.saved(forms.where("form <> ''").select("form").distinct().select("form", F.lit(1).cast("long").alias("n"), none.alias("first"), none.alias("crc")), "forms")
        rows = _dealt(own, queries.where("form <> ''").select("form").distinct(), k, scratch)
        return saved(rows.mapInArrow(_chunks(k, _pairs, _PAIR), "query string, form string, distance int"), "name_pairs")


def name_join(left: DataFrame, right: DataFrame, left_id: str, left_name: str, right_id: str, right_name: Column, k: int = MAX_DISTANCE) -> DataFrame:
    """For each row of right and each exact distance up to k: (id, distance, n, first, crc) of the rows of left so far from its name."""
    with Scratch(left.sparkSession) as scratch:
        forms = scratch.saved(_forms(left, left_name, left_id), "forms")
        asked = scratch.saved(right.select(F.col(f"`{right_id}`").alias("id"), normalised(right_name).alias("form")).where("form is not null"), "asked")
        rows = _dealt(forms, asked.select("form").distinct(), k, scratch)
        found = rows.mapInArrow(_chunks(k, _totals, _TOTAL), "form string, distance int, n long, first long, crc long")
        totals = found.groupBy("form", "distance").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("crc").alias("crc"))
        return saved(asked.join(totals.hint("merge"), "form").select("id", "distance", "n", "first", "crc"), "name_join")


def op12_name_join(spark, sf_dir: str) -> DataFrame:
    clients, vendors = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("clients", "vendors"))
    found = name_join(clients, vendors, "client_id", "name", "vendor_id", misspelt("name", "vendor_id"))
    return found.select(F.col("id").alias("vendor_id"), "distance", F.col("n").alias("n_clients"), F.col("first").alias("first_client_id"), F.col("crc").alias("clients_crc"))


#: crc32 bit by bit, and pairs within distance 1 by equal texts, equal deletions and equal exchanges.
ORACLE = r"""
WITH clients_ AS (
  SELECT client_id, regexp_replace(translate(name, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]', '', 'g') AS form,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(client_id::VARCHAR, '')])),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END)) AS crc
  FROM clients WHERE name IS NOT NULL
), hashed AS (
  SELECT vendor_id, name, length(name) AS l,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(vendor_id::VARCHAR, '')])),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END)) AS h
  FROM vendors WHERE name IS NOT NULL
), spelt AS (
  SELECT vendor_id, CASE WHEN h % 2 = 0 AND l >= 2
    THEN substr(name, 1, (h % (l - 1))::INT) || substr(name, (h % (l - 1))::INT + 2, 1) || substr(name, (h % (l - 1))::INT + 1, 1) || substr(name, (h % (l - 1))::INT + 3)
    ELSE name END AS name FROM hashed
), vendors_ AS (
  SELECT vendor_id, regexp_replace(translate(name, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]', '', 'g') AS form FROM spelt
), c AS (SELECT form, count(*) AS n, min(client_id) AS first, sum(crc) AS crc FROM clients_ WHERE form <> '' GROUP BY form
), v AS (SELECT DISTINCT form FROM vendors_ WHERE form <> ''
), cd AS (SELECT form, i, substr(form, 1, i - 1) || substr(form, i + 1) AS less FROM c, unnest(range(1, length(form) + 1)) AS t(i)
), vd AS (SELECT form, i, substr(form, 1, i - 1) || substr(form, i + 1) AS less FROM v, unnest(range(1, length(form) + 1)) AS t(i)
), vx AS (SELECT form, substr(form, 1, i - 1) || substr(form, i + 1, 1) || substr(form, i, 1) || substr(form, i + 2) AS other FROM v, unnest(range(1, length(form))) AS t(i)
), near AS (
  SELECT v.form AS v, c.form AS c FROM v JOIN c ON v.form = c.form
  UNION SELECT cd.less, cd.form FROM cd JOIN v ON v.form = cd.less
  UNION SELECT vd.form, vd.less FROM vd JOIN c ON c.form = vd.less
  UNION SELECT vd.form, cd.form FROM vd JOIN cd ON vd.i = cd.i AND vd.less = cd.less
  UNION SELECT vx.form, vx.other FROM vx JOIN c ON c.form = vx.other
)
SELECT vendor_id, CAST(near.v <> near.c AS INTEGER) AS distance, CAST(sum(c.n) AS BIGINT) AS n_clients, min(c.first) AS first_client_id, CAST(sum(c.crc) AS BIGINT) AS clients_crc
FROM vendors_ JOIN near ON near.v = vendors_.form JOIN c ON c.form = near.c GROUP BY vendor_id, CAST(near.v <> near.c AS INTEGER)
"""
