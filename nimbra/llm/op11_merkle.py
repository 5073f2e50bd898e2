"""A manifest of a table as Merkle trees, one per group under one root, with a proof for every row.

Rows are leaves, numbered within their group. The number of a leaf is written in digits of
base ``1 << LEVELS``; blocks of ``DIGITS`` digits hold a bounded number of leaves. In a block
the lowest digit is grouped away first: nodes that agree in the higher digits become one
struct that nests them together with the digests of the binary levels between. The blocks'
own digests are leaves of the next, much shorter round. On the way back each block is
unfolded from its top: every child takes the siblings above it along, so proofs come out of
one transform and one explode, without a join of leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nimbra.llm.common import materialize, ranked, table

#: Binary levels of a digit, and digits of a block: 4,096 leaves are the most in one group.
LEVELS, DIGITS = 4, 3
_BLOCK = LEVELS * DIGITS
#: A step of a path: the sibling on its side, or a null digest where the node is alone in its run.
_STEP = "struct<left: boolean, digest: string>"
_PATH = f"array<{_STEP}>"


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value so that no two sequences of fields read alike: length in bytes, colon, text; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _parents(nodes: Column) -> Column:
    """Digests of runs of two; the last run may be a single node."""
    pairs = (F.size(nodes) + 1).cast("int").bitwiseAND(-2) / 2
    return F.transform(
        F.sequence(F.lit(0), pairs.cast("int") - 1),
        lambda i: digest(F.get(nodes, i * 2), F.coalesce(F.get(nodes, i * 2 + 1), F.lit(""))),
    )


def _levels(children: Column, count: Column) -> Column:
    """``count`` binary levels above the digests of ``children``, which are the first of the rows."""
    steps = F.slice(F.array(*[F.lit(i) for i in range(LEVELS)]), F.lit(1), count)
    return F.aggregate(
        steps, F.array(children), lambda rows, _: F.concat(rows, F.array(_parents(F.element_at(rows, -1))))
    )


def _fold_blocks(nodes: DataFrame, group: str, height: int) -> DataFrame:
    """Blocks of ``nodes`` (group, rank, levels, node: struct with a digest ``d``) that stand
    ``height`` levels above the leaves; ``levels`` are those of the whole group."""
    digits = [f"digit {i}" for i in range(DIGITS)]
    rank = F.col("rank")
    dealt = nodes.select(
        group,
        F.call_function("shiftright", rank, F.lit(_BLOCK)).alias("block"),
        "levels",
        "node",
        *[
            F.call_function("shiftright", rank, F.lit(LEVELS * i)).bitwiseAND((1 << LEVELS) - 1).alias(digit)
            for i, digit in enumerate(digits)
        ],
    ).repartition(group, "block")
    for i in range(DIGITS):
        here, *higher = digits[i:]
        children = dealt.groupBy(group, "block", *higher).agg(
            F.max("levels").alias("levels"),
            F.transform(F.array_sort(F.collect_list(F.struct(here, "node"))), lambda x: x["node"]).alias("children"),
        )
        present = F.greatest(F.least(F.col("levels") - height - LEVELS * i, F.lit(LEVELS)), F.lit(0)).cast("int")
        rows = _levels(F.transform("children", lambda x: x["d"]), present)
        dealt = children.withColumn("rows", rows).select(
            group,
            "block",
            *higher,
            "levels",
            F.struct(F.element_at(F.element_at("rows", -1), 1).alias("d"), "rows", "children").alias("node"),
        )
    return dealt


def _rounds(leaves: DataFrame, group: str, label: str) -> list[DataFrame]:
    """Tables of blocks, from those of the leaves to one with a block for each group."""
    nodes, tables = leaves, []
    while True:
        tables.append(materialize(_fold_blocks(nodes, group, _BLOCK * len(tables)), label))
        if not tables[-1].where("block > 0").limit(1).count():
            return tables
        tops = tables[-1].select(
            group, F.col("block").alias("rank"), "levels",
            F.struct(F.col("node.d").alias("d"), F.col("block").alias("payload")).alias("node"),
        )
        nodes = tops


def _own_steps(rows: Column, place: Column) -> Column:
    """Steps from a child at ``place`` up to the top of its node."""

    def step(row: Column, level: Column) -> Column:
        at = F.call_function("shiftright", place, level)
        return F.struct(
            at.bitwiseAND(1).cast("boolean").alias("left"), F.get(row, at.bitwiseXOR(F.lit(1))).alias("digest")
        )

    return F.transform(F.slice(rows, F.lit(1), F.size(rows) - 1), step)


def _unfold(blocks: DataFrame, above: DataFrame, group: str) -> DataFrame:
    """Children of all blocks: group, payload, d, path (own and that of ``above``: group, block,
    path, more). A block meets its path in one aggregate of two rows."""
    met = (
        blocks.select(group, "block", "node")
        .unionByName(above, allowMissingColumns=True)
        .groupBy(group, "block")
        .agg(*[F.first(name, ignorenulls=True).alias(name) for name in ("node", "path", "more")])
    )
    items = F.array(F.struct("node", "path"))
    for _ in range(DIGITS):
        items = F.flatten(
            F.transform(
                items,
                lambda it: F.transform(
                    it["node"]["children"],
                    lambda child, i: F.struct(
                        child.alias("node"),
                        F.concat(_own_steps(it["node"]["rows"], i), it["path"]).alias("path"),
                    ),
                ),
            )
        )
    return met.select(group, "more", F.explode(items).alias("item")).select(
        group, "more", F.col("item.node.d").alias("d"), F.col("item.node.payload").alias("payload"), "item.path"
    )


def _proved(tables: list[DataFrame], above: DataFrame, group: str, label: str) -> DataFrame:
    """Leaves with their paths, unfolding the tables from the last one down."""
    for i, blocks in reversed(list(enumerate(tables))):
        children = _unfold(blocks, above, group)
        if i:
            above = materialize(
                children.select(group, F.col("payload").alias("block"), "path", "more"), label
            )
    return children


def _levels_of(size: Column) -> Column:
    """Levels above ``size`` nodes: 0 for a single one."""
    return F.when(size > 1, F.length(F.conv((size - 1).cast("string"), 10, 2))).otherwise(0)


def manifest(
    docs: DataFrame,
    id_col: str,
    group_col: str,
    fields: list[Column],
    payload: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, group, the ``payload`` columns, leaf, path, subroot, root.

    ``path`` leads from the leaf over the subroot of its group to the root: a step has the
    digest of the sibling (null: none) and whether that stands on the left. Leaves of a group
    ascend by id, null first, repeated ids by their digest; rows that are equal in all fields
    have equal leaves and proofs of their own. A null group is a group and comes first. An
    empty table gives no rows. Other columns of ``docs`` play no part.
    """
    more = [c.alias(name) for name, c in (payload or {}).items()]
    leaves = docs.select(
        F.col(group_col).alias("group"),
        F.col(id_col).alias("id"),
        digest(*[field(value) for value in fields]).alias("d"),
        F.struct(F.col(id_col).alias("id"), *more).alias("payload"),
    )
    numbered = ranked(materialize(leaves, "merkle-leaves"), "group", ["id", "d"], "rank", "size").select(
        "group", "rank", _levels_of(F.col("size")).alias("levels"), F.struct("d", "payload").alias("node")
    )
    trees = _rounds(numbered, "group", "merkle-blocks")

    one = F.lit(0).alias("all")
    subroots = trees[-1].select(one, "group", F.col("node.d").alias("d"))
    ordered = ranked(subroots, "all", ["group"], "rank", "size").select(
        "all", "rank", _levels_of(F.col("size")).alias("levels"),
        F.struct("d", F.struct("group").alias("payload")).alias("node"),
    )
    tops = _rounds(ordered, "all", "merkle-tops")

    root = tops[-1].select(
        "all", "block", F.array().cast(_PATH).alias("path"), F.struct(F.col("node.d").alias("root")).alias("more")
    )
    groups = _proved(tops, root, "all", "merkle-paths").select(
        F.col("payload.group").alias("group"),
        F.lit(0).cast("bigint").alias("block"),
        "path",
        F.struct(F.col("d").alias("subroot"), "more.root").alias("more"),
    )
    return _proved(trees, materialize(groups, "merkle-paths"), "group", "merkle-paths").select(
        F.col("payload.id").alias(id_col),
        F.col("group").alias(group_col),
        *[F.col("payload")[name].alias(name) for name in payload or {}],
        F.col("d").alias("leaf"),
        "path",
        "more.subroot",
        "more.root",
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path lead to."""
    return F.aggregate(
        path,
        leaf,
        lambda node, step: F.when(step["digest"].isNull(), digest(node))
        .when(step["left"], digest(step["digest"], node))
        .otherwise(digest(node, step["digest"])),
    )


def siblings(path: Column) -> Column:
    """The digests of a path, one after the other."""
    return F.array_join(F.transform(path, lambda step: step["digest"]), "")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    tampered = F.crc32(id_text.cast("binary")) % 7 == 0
    fields = {name: F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")}
    # the largest number has a successor too
    forged = fields | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    shown = F.when(tampered, digest(*[field(value) for value in forged.values()]))
    proved = manifest(table(spark, sf_dir, "documents"), "doc_id", "lang", list(fields.values()), {"forged": shown})
    again = folded(F.coalesce("forged", "leaf"), F.col("path"))
    return proved.withColumn("folded_root", again).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: crc32 runs over the digits of an id, eight shifts each.
ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, source, n_chars, text,
         list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                             lambda x: CAST(ascii(x) AS BIGINT))),
                     lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                                              lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384)
                                                                ELSE v // 2 END)) AS crc
  FROM documents
), fields AS (
  SELECT *, COALESCE(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
            || COALESCE(strlen(source) || ':' || source, '-')
            || COALESCE(strlen(lang) || ':' || lang, '-') AS front,
         COALESCE(strlen(text) || ':' || text, '-') AS back,
         COALESCE(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS chars,
         COALESCE(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS more_chars
  FROM d
), leaves AS (
  SELECT doc_id, lang, sha256(front || chars || back) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN sha256(front || more_chars || back)
              ELSE sha256(front || chars || back) END AS shown
  FROM fields
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
         count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
), trees AS (
  SELECT lang, 0 AS lvl, r AS i, n, leaf AS d FROM numbered
  UNION ALL
  SELECT lang, lvl, i, (n + 1) // 2 AS n, d FROM (
    SELECT lang, lvl + 1 AS lvl, i // 2 AS i, n,
           sha256(string_agg(d, '' ORDER BY i)) AS d
    FROM trees WHERE n > 1 GROUP BY lang, lvl, i // 2, n)
), subroots AS (
  SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS n
  FROM trees WHERE n = 1
), tops AS (
  SELECT 0 AS lvl, r AS i, n, subroot AS d FROM subroots
  UNION ALL
  SELECT lvl, i, (n + 1) // 2 AS n, d FROM (
    SELECT lvl + 1 AS lvl, i // 2 AS i, n, sha256(string_agg(d, '' ORDER BY i)) AS d
    FROM tops WHERE n > 1 GROUP BY lvl, i // 2, n)
), low AS (
  SELECT doc_id, a.lang, r, a.leaf,
         list((CASE WHEN s.d IS NULL THEN '-' WHEN s.i < v.i THEN 'L' ELSE 'R' END) || COALESCE(s.d, '') ORDER BY v.lvl)
           FILTER (WHERE v.lvl IS NOT NULL) AS path
  FROM numbered a
  LEFT JOIN trees v ON v.lang IS NOT DISTINCT FROM a.lang AND v.n > 1 AND v.i = a.r >> v.lvl
  LEFT JOIN trees s ON s.lang IS NOT DISTINCT FROM v.lang AND s.lvl = v.lvl AND s.i = xor(v.i, 1)
  GROUP BY ALL
), high AS (
  SELECT a.lang, a.subroot,
         list((CASE WHEN s.d IS NULL THEN '-' WHEN s.i < v.i THEN 'L' ELSE 'R' END) || COALESCE(s.d, '') ORDER BY v.lvl)
           FILTER (WHERE v.lvl IS NOT NULL) AS path
  FROM subroots a
  LEFT JOIN tops v ON v.n > 1 AND v.i = a.r >> v.lvl
  LEFT JOIN tops s ON s.lvl = v.lvl AND s.i = xor(v.i, 1)
  GROUP BY ALL
), paths AS (
  SELECT a.doc_id, a.leaf, a.shown, high.subroot,
         list_concat(COALESCE(low.path, []), COALESCE(high.path, [])) AS path
  FROM numbered a JOIN low ON low.lang IS NOT DISTINCT FROM a.lang AND low.r = a.r
  JOIN high ON high.lang IS NOT DISTINCT FROM a.lang
)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_prepend('', list_transform(path, lambda x: x[2:])), 'string_agg', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM (
  SELECT *, (SELECT d FROM tops WHERE n = 1) AS root,
         list_reduce(list_prepend(shown, path),
                     lambda node, s: sha256(CASE WHEN s[1] = '-' THEN node WHEN s[1] = 'L' THEN s[2:] || node
                                                 ELSE node || s[2:] END)) AS folded_root
  FROM paths
)
"""
