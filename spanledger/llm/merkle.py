"""Merkle manifest of a dataset: a tree of 16 children a node per source, and one over the sources' roots; proofs by slot pivots.

H is the lower-case hex SHA-256 of its inputs one after another, digests as hex text. A leaf is H of doc_id, source, lang, n_chars and
text, each `-` if null, else its UTF-8 byte count, `:` and the value. In a source, leaves ascend by doc_id (null first; equal ones by
leaf); while there are several nodes, every 16 in a row become their H, the last ones fewer. What remains is the subroot. Subroots,
ordered by source (null first, then by bytes), give the root in the same way.

1. Leaves are sorted by ranges of (source, doc_id, leaf) and written; a leaf's number in its source is its place in the partition
   plus the leaves of that source in partitions before. So no source is sorted or numbered in one task.
2. Slot pivot: conditional aggregates spread the children of a parent into 16 columns, whatever the source; the columns after
   one another hash to the parent. One written table per level, each a sixteenth of the one before.
3. From the top down, every parent hands each child its siblings (all slot columns but the child's own) in front of its own path.
   The path of a leaf is hashed for the proof, and folded with the leaf, tampered or not, into a root to compare.

Tampering: where 5 divides the unsigned crc32 of the decimal doc_id (null: never), A-Z of the text become lower case.

Repeated rows are leaves of their own. A single leaf is its subroot, a single subroot the root; their proofs hash nothing.
A very long text is one row's work, hashed where it is read; it never travels. An empty table gives an empty result. Columns beside the five
are neither hashed nor returned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from spanledger.llm.common import table, written
from spanledger.llm.line_dedup import lower_ascii

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 5
_PATH = "array<struct<slot:int,others:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, and changed: the leaf of the tampered text, where a row is tampered with."""
    values = [field(F.col(c)) for c in FIELDS[:-1]]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return docs.select(
        "doc_id", "source", digest(*values, field(F.col("text"))).alias("leaf"),
        F.when(hit, digest(*values, field(lower_ascii(F.col("text"))))).alias("changed"),
    )


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows with part and at, and per (group, part): first `at`, rows of the group in parts before, and its total.

    Rows equal in every column are spread by where they are read.
    """
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    by = [group, *order, "salt"]
    placed = salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("salt").withColumn("at", F.monotonically_increasing_id())
    placed = written(placed, name).withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy(group, "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy(group)
    before = F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    parts = parts.select(group, "part", "first", before.alias("before"), F.sum("n").over(own).alias("total"))
    return placed, written(parts, f"{name}-parts")


# ------------------------------------------------------------------ up: slot pivots

def _slot(i: int) -> str:
    return f"c{i}"


def climb(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Tables of parents, lowest first, and per group its top node's hash.

    nodes: grp, total (nodes of the group), idx and cell, a struct with hash; a parent row keeps its children's cells in 16 columns.
    """
    tables, tops = [], [nodes.filter("total = 1").select("grp", "cell.hash")]
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        slot = F.pmod("idx", F.lit(FANOUT))
        spread = [F.max(F.when(slot == i, F.col("cell"))).alias(_slot(i)) for i in range(FANOUT)]
        parents = nodes.filter("total > 1").groupBy("grp", "total", F.expr(f"idx div {FANOUT}").alias("idx")).agg(*spread)
        parents = parents.select(
            "grp", F.expr(f"(total + {FANOUT - 1}) div {FANOUT}").alias("total"), "idx", *map(_slot, range(FANOUT)),
            digest(*(F.coalesce(F.col(f"{_slot(i)}.hash"), F.lit("")) for i in range(FANOUT))).alias("hash"),
        )
        parents = written(parents, f"{name}-{len(tables) + 1}")
        tables.append(parents)
        tops.append(parents.filter("total = 1").select("grp", "hash"))
        nodes = parents.select("grp", "total", "idx", F.struct("hash").alias("cell"))
        most = -(-most // FANOUT)
    return tables, reduce(DataFrame.unionByName, tops)


# ------------------------------------------------------------------ down: siblings

def descend(tables: list[DataFrame], nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Every node of the lowest level with its path: of each level the own slot and the siblings, lowest level first.

    above: one row per group, grp, path above its top, and further columns that every node gets.
    """
    extra = [c for c in above.columns if c not in ("grp", "path")]
    others = [
        F.concat(*(F.coalesce(F.col(f"{_slot(j)}.hash"), F.lit("")) for j in range(FANOUT) if j != i)) for i in range(FANOUT)
    ]
    carried = None
    for parents in reversed(tables):
        found = parents.filter("total = 1").join(above, "grp")
        if carried is not None:
            found = found.unionByName(parents.filter("total > 1").join(carried.drop("cell"), ["grp", "idx"]))
        slots = F.array(*(F.struct(F.lit(i).alias("slot"), F.col(_slot(i)).alias("cell"), others[i].alias("others")) for i in range(FANOUT)))
        children = found.select("grp", "idx", "path", *extra, F.explode(F.filter(slots, lambda s: s["cell"].isNotNull())).alias("s"))
        carried = children.select(
            "grp", (F.col("idx") * FANOUT + F.col("s.slot")).alias("idx"), F.col("s.cell").alias("cell"),
            F.concat(F.array(F.struct(F.col("s.slot").alias("slot"), F.col("s.others").alias("others"))), F.col("path")).alias("path"), *extra,
        )
    alone = nodes.filter("total = 1").join(above, "grp").select("grp", "idx", "cell", "path", *extra)
    return alone if carried is None else carried.unionByName(alone)


def proof(path: Column) -> Column:
    return digest(F.array_join(path["others"], ""))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    width = 64

    def up(node: Column, step: Column) -> Column:
        cut = step["slot"] * width
        return digest(F.substring(step["others"], F.lit(1), cut), node, F.substr(step["others"], cut + 1))

    return F.aggregate(path, start, up)


# ------------------------------------------------------------------ manifest

class Manifest:
    """The tree over documents: leaves with their group (the source's number), levels, subroots and root, all as written tables."""

    def __init__(self, docs: DataFrame) -> None:
        placed, parts = ranked(leaves(docs), "source", ["doc_id", "leaf"], "leaves")
        names = parts.groupBy("source").agg(F.max("total").alias("total"))
        named, runs = ranked(names.withColumn("whole", F.lit(0)), "whole", ["source"], "sources")
        number = (F.col("at") - F.col("first") + F.col("before")).alias("grp")
        self.sources = written(named.join(runs, ["whole", "part"]).select("source", number), "numbers")
        groups = parts.join(self.sources, parts["source"].eqNullSafe(self.sources["source"])).select(
            parts["source"].alias("of"), "grp", "part", "first", "before", "total"
        )
        joined = placed.join(groups, (placed["part"] == groups["part"]) & placed["source"].eqNullSafe(groups["of"]))
        cell = F.struct(F.col("leaf").alias("hash"), "doc_id", "changed").alias("cell")
        self.nodes = joined.select("grp", "total", (F.col("at") - F.col("first") + F.col("before")).alias("idx"), cell)
        self.levels, tops = climb(self.nodes, "merkle")
        self.subroots = written(tops, "subroots")
        count = self.subroots.count()
        self.upper = self.subroots.select(F.lit(0).alias("grp"), F.lit(count).cast("bigint").alias("total"), F.col("grp").alias("idx"), F.struct("hash").alias("cell"))
        self.upper_levels, self.root = climb(self.upper, "merkle-top")

    def table(self) -> DataFrame:
        """Every node above the leaves: tier (source or top), level from 1, source (of its tier), idx, hash."""
        out = []
        for tier, levels in (("source", self.levels), ("top", self.upper_levels)):
            for level, nodes in enumerate(levels, 1):
                rows = nodes.select(F.lit(tier).alias("tier"), F.lit(level).alias("level"), "grp", "idx", "hash")
                if tier == "source":
                    rows = rows.join(self.sources, "grp").drop("grp")
                else:
                    rows = rows.withColumn("source", F.lit(None).cast("string")).drop("grp")
                out.append(rows.select("tier", "level", "source", "idx", "hash"))
        kind = "tier string, level int, source string, idx bigint, hash string"
        return reduce(DataFrame.unionByName, out) if out else self.nodes.sparkSession.createDataFrame([], kind)

    def proofs(self) -> DataFrame:
        """doc_id, leaf, changed, subroot, root and path of every leaf."""
        start = self.root.select("grp", F.col("hash").alias("root"), F.array().cast(_PATH).alias("path"))
        tops = descend(self.upper_levels, self.upper, start)
        tops = tops.select(F.col("idx").alias("grp"), "path", F.col("cell.hash").alias("subroot"), "root")
        found = descend(self.levels, self.nodes, written(tops, "tops"))
        return found.select("cell.doc_id", F.col("cell.hash").alias("leaf"), "cell.changed", "subroot", "root", "path")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document."""
    folds = folded(F.coalesce("changed", "leaf"), F.col("path"))
    out = Manifest(docs).proofs().select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folds.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The tree in SQL, for up to 16^6 leaves a source and as many sources."""
    depth = 6
    fields = ", ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in FIELDS)
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # the polynomial of CRC-32, bits reversed
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce(list_prepend(CAST(xor(a, CAST(ord(b) AS BIGINT)) AS BIGINT), range(8)), lambda c, k: {step})"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), range(1, length(CAST(doc_id AS VARCHAR)) + 1)), lambda a, i: {byte.replace('ord(b)', 'ord(substr(CAST(doc_id AS VARCHAR), CAST(i AS INT), 1))')}), 4294967295)"
    out = [
        f"WITH d AS (SELECT doc_id, source, sha256(concat({fields})) AS leaf, "
        f"CASE WHEN {crc} % {TAMPERED} = 0 THEN sha256(concat({fields.replace('CAST(text AS VARCHAR)', lower)})) END AS changed FROM documents)",
        "l AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, "
        "row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)",
    ]

    def tree(tier: str, base: str) -> None:
        out.append(f"{tier}0 AS (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS n FROM ({base}))")
        for k in range(depth):
            out.append(
                f"{tier}{k + 1} AS (SELECT g, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, (n + 15) // 16 AS n FROM {tier}{k} WHERE n > 1 "
                f"GROUP BY g, i // 16, n UNION ALL SELECT g, i, h, n FROM {tier}{k} WHERE n = 1)"
            )
            # siblings of every node of level k; none where the group is done
            out.append(
                f"{tier}s{k} AS (SELECT a.g, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lo, "
                f"coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS hi, a.n > 1 AS live FROM {tier}{k} a "
                f"JOIN {tier}{k} b ON a.g = b.g AND a.i // 16 = b.i // 16 GROUP BY a.g, a.i, a.n)"
            )

    tree("t", "SELECT g, i, leaf AS h FROM l")
    tree("u", f"SELECT 0 AS g, g AS i, h FROM t{depth}")
    # a lone node stays at its place, so a group that is done has live = false from there on
    siblings, fold = [], "coalesce(changed, leaf)"
    joins = []
    for tier, place in (("t", "l.i"), ("u", "l.g")):
        for k in range(depth):
            name = f"{tier}s{k}"
            group = "l.g" if tier == "t" else "0"
            joins.append(f"JOIN {name} ON {name}.g = {group} AND {name}.i = {place} // {16 ** k}")
            siblings.append(f"CASE WHEN {name}.live THEN {name}.lo || {name}.hi ELSE '' END")
    steps = [("t", k) for k in range(depth)] + [("u", k) for k in range(depth)]
    columns = ", ".join(f"{t}s{k}.lo AS {t}lo{k}, {t}s{k}.hi AS {t}hi{k}, {t}s{k}.live AS {t}live{k}" for t, k in steps)
    out.append(
        f"p AS (SELECT doc_id, leaf, t{depth}.h AS subroot, u{depth}.h AS root, sha256(concat({', '.join(siblings)})) AS proof_sha256, {fold} AS f0, {columns} "
        f"FROM l {' '.join(joins)} JOIN t{depth} ON t{depth}.g = l.g CROSS JOIN u{depth})"
    )
    for at, (t, k) in enumerate(steps):
        out.append(f"f{at + 1} AS (SELECT *, CASE WHEN {t}live{k} THEN sha256({t}lo{k} || f{at} || {t}hi{k}) ELSE f{at} END AS f{at + 1} FROM {'p' if not at else f'f{at}'})")
    last = len(steps)
    return ",\n".join(out) + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, f{last} AS folded_root, f{last} = root AS verified FROM f{last}"


ORACLE = _oracle()
