"""Column-level lineage kept as an edge table and queried with joins.

Edges have the columns batch_id, source, target, transform, stage, ts and
metadata (JSON text). A node is a ``layer.column`` name.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.fixed_values import DEFAULT_COLOUR, LAYER_COLOURS, LAYER_ORDER
from tradeloom.functions.staging import exists, scratch_path, settle, watched

EDGE_SCHEMA = (
    "batch_id string, source string, target string, transform string, stage string, "
    "ts timestamp, metadata string"
)
EDGE_ATTRIBUTES = ["transform", "stage", "batch_id", "metadata"]
BASE_IRI = "http://example.org/lineage/"


# --- building ----------------------------------------------------------------

def merge(*edge_tables: DataFrame) -> DataFrame:
    """All edges of several tables, duplicates included."""
    merged, *rest = edge_tables
    for table in rest:
        merged = merged.unionByName(table)
    return merged


def for_batch(edges: DataFrame, batch_id: str | None) -> DataFrame:
    return edges if batch_id is None else edges.where(F.col("batch_id") == batch_id)


def of_latest_run(stored: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of a table partitioned by batch that belong to the latest run with a finished stage.

    The batch is found when the query runs; only its folders are read (dynamic partition
    pruning by the broadcast of one row).
    """
    newest = F.max_by("batch_id", F.struct("started_at", "batch_id")).alias("batch_id")
    latest = runs.where(F.col("status") == "SUCCESS").agg(newest)
    return stored.join(F.broadcast(latest), "batch_id")


def collapse(edges: DataFrame) -> DataFrame:
    """One edge per (source, target); the last one emitted wins."""
    last = F.max(F.struct("ts", *EDGE_ATTRIBUTES)).alias("_last")
    return edges.groupBy("source", "target").agg(last).select(
        "source", "target", *[f"_last.{a}" for a in EDGE_ATTRIBUTES]
    )


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("source", "target")).alias("node")).distinct()


# --- reachability ------------------------------------------------------------

def ancestors(edges: DataFrame, node: str) -> DataFrame:
    """Upstream nodes with their shortest distance; farthest first."""
    return _reach(edges.select(F.col("target").alias("a"), F.col("source").alias("b")), node).orderBy(
        F.desc("dist"), "node"
    )


def descendants(edges: DataFrame, node: str) -> DataFrame:
    """Downstream nodes with their shortest distance; nearest first."""
    return _reach(edges.select(F.col("source").alias("a"), F.col("target").alias("b")), node).orderBy(
        "dist", "node"
    )


def _reach(links: DataFrame, start: str) -> DataFrame:
    """Breadth-first search over (a, b) links, one written frontier per level.

    A node is expanded once, so cycles end and diamonds do not multiply. Levels
    are folders of one table; the written size of a frontier decides whether it
    is joined by broadcast.
    """
    spark = links.sparkSession
    links = settle(links.distinct(), "links")
    root = scratch_path(spark, "levels")
    first = spark.createDataFrame([(start,)], "node string")
    first.write.parquet(f"{root}/dist=0")
    level = 0
    while True:
        seen = spark.read.schema("node string, dist int").parquet(root)
        frontier = spark.read.schema("node string").parquet(f"{root}/dist={level}")
        if frontier.isEmpty():
            return seen.where("dist > 0")
        level += 1
        step = (
            links.join(frontier.select(F.col("node").alias("a")), "a", "left_semi")
            .select(F.col("b").alias("node"))
            .distinct()
            .join(seen, "node", "left_anti")
        )
        step.write.parquet(f"{root}/dist={level}")


#: Buckets of links and of graph states; some hundred megabytes each at full size.
LINK_BUCKETS = 16


class Links:
    """Distinct links stored by bucket of either end, for searches that read only what a frontier touches."""

    def __init__(self, edges: DataFrame, buckets: int = LINK_BUCKETS):
        self.spark, self.buckets = edges.sparkSession, buckets
        self.path = scratch_path(self.spark, "links")
        ends = [
            F.struct(F.lit(near).alias("side"), F.col(near).alias("near"), F.col(far).alias("far"))
            for near, far in (("source", "target"), ("target", "source"))
        ]
        links = edges.select("source", "target").distinct().select(F.inline(F.array(*ends)))
        # A link's two rows lie where searches from either end look for them.
        rows = links.withColumn("bucket", self._bucket("near")).repartition("side", "bucket")
        rows.write.partitionBy("side", "bucket").parquet(self.path)

    def _bucket(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("int")

    def from_(self, nodes_: DataFrame, near: str) -> DataFrame:
        """(near, far) links at the given nodes (column ``node``); only their buckets are read."""
        wanted = [r.bucket for r in nodes_.select(self._bucket("node").alias("bucket")).distinct().collect()]  # at most all buckets
        links = self.spark.read.schema("near string, far string, side string, bucket int").parquet(self.path)
        links = links.where((F.col("side") == near) & F.col("bucket").isin(wanted)).select("near", "far")
        return links.join(nodes_.select(F.col("node").alias("near")), "near", "left_semi")

    def known(self, node: str) -> bool:
        """Whether the node is an end of any link."""
        one = self.spark.createDataFrame([(node,)], "node string")
        return any(not self.from_(one, near).isEmpty() for near in ("source", "target"))


class _Frontiers:
    """Nodes by their distance from one end, a folder for each level; a node is listed once."""

    def __init__(self, links: Links, near: str, start: str):
        self.links, self.near, self.level = links, near, 0
        self.spark = links.spark
        self.root = scratch_path(self.spark, f"levels-{near}")
        first = self.spark.createDataFrame([(start,)], "node string")
        first.write.parquet(f"{self.root}/dist=0")
        self.size = 1

    def at(self, level: int) -> DataFrame:
        return self.spark.read.schema("node string").parquet(f"{self.root}/dist={level}")

    def seen(self) -> DataFrame:
        return self.spark.read.schema("node string, dist int").parquet(self.root)

    def grow(self) -> None:
        """Write the next level."""
        step = self.links.from_(self.at(self.level), self.near).select(F.col("far").alias("node")).distinct()
        rows, counted = watched(step.join(self.seen(), "node", "left_anti"))
        self.level += 1
        rows.write.parquet(f"{self.root}/dist={self.level}")
        self.size = counted.get["rows"]


def shortest_path(edges: DataFrame, source: str, target: str, buckets: int = LINK_BUCKETS) -> DataFrame:
    """Nodes of the shortest path by position; no rows if there is none.

    Of several shortest paths the one with the smallest node names is taken. The search
    grows from both ends, the smaller frontier first but neither more than one level
    ahead, until a level of one meets the last level of the other. What is stored of a
    node is its distance; the path is then read off one node at a time: from the source
    the smallest next node among those that lead on to the meeting level, and from there
    the smallest next node among those one step nearer to the target.
    """
    links = Links(edges, buckets)
    spark = links.spark
    if source == target:
        found = [(0, source)] if links.known(source) else []
        return spark.createDataFrame(found, "position int, node string")
    ends = ahead, back = _Frontiers(links, "source", source), _Frontiers(links, "target", target)
    while True:
        meeting = ahead.at(ahead.level).join(back.at(back.level), "node", "left_semi")
        if not meeting.isEmpty():
            break
        if not (ahead.size and back.size):
            return spark.createDataFrame([], "position int, node string")
        min(ends, key=lambda side: (side.level, side.size)).grow()
    # Of each level behind the meeting one, the nodes that lead to it.
    useful = [settle(meeting, "meeting")]
    for level in range(ahead.level - 1, 0, -1):
        before = links.from_(useful[0], "target").select(F.col("far").alias("node")).distinct()
        useful.insert(0, settle(ahead.at(level).join(before, "node", "left_semi"), "useful"))
    layers = useful if ahead.level else []
    layers = [*layers, *[back.at(level) for level in range(back.level - 1, -1, -1)]]
    path = [source]
    for layer in layers:
        here = spark.createDataFrame([(path[-1],)], "node string")
        onward = links.from_(here, "source").select(F.col("far").alias("node"))
        path.append(onward.join(layer, "node", "left_semi").agg(F.min("node")).first()[0])
    return spark.createDataFrame(list(enumerate(path)), "position int, node string")


# --- a collapsed graph that is kept ------------------------------------------------

class GraphStore:
    """The collapsed graph of all batches so far, one state per edge, updated batch by batch.

    The state of an edge is its last emitted attributes with their time. The later of two
    states is again a state, so batches may arrive in any order and a batch may be folded
    in twice. Edges are kept in buckets; folding in a batch rewrites only the buckets that
    it touches, in folders of its own, and becomes visible with its row in ``folds``,
    written last.
    """

    STATE = ["source", "target", "ts", *EDGE_ATTRIBUTES]

    def __init__(self, spark: SparkSession, root: str, buckets: int = LINK_BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _folds(self) -> DataFrame | None:
        path = f"{self.root}/folds"
        return self.spark.read.schema("fold int, bucket int").parquet(path) if exists(self.spark, path) else None

    def _states(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The newest states of the buckets (all without a list)."""
        folds = self._folds()
        if folds is None:
            return None
        newest = dict(folds.groupBy("bucket").agg(F.max("fold")).collect())  # one entry a bucket
        chosen = [(b, f) for b, f in newest.items() if buckets is None or b in buckets]
        if not chosen:
            return None
        paths = [f"{self.root}/states/bucket={b}/fold={f}" for b, f in chosen]
        return self.spark.read.option("basePath", f"{self.root}/states").parquet(*paths).select("bucket", *self.STATE)

    def fold(self, batch: DataFrame) -> list[int]:
        """Take in the edges of a batch; returns the buckets that were rewritten."""
        place = F.pmod(F.xxhash64("source", "target"), F.lit(self.buckets)).cast("int")
        new = settle(self._merged(batch).withColumn("bucket", place), "fold")
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most all buckets
        if not touched:
            return []
        folds, old = self._folds(), self._states(touched)
        number = 1 if folds is None else folds.agg(F.max("fold")).first()[0] + 1
        while exists(self.spark, f"{self.root}/attempts/fold={number}"):  # one that never became visible
            number += 1
        self.spark.range(1).write.parquet(f"{self.root}/attempts/fold={number}")
        rows = self._updated(new.select("bucket", *self.STATE), old).withColumn("fold", F.lit(number))
        rows.write.mode("append").partitionBy("bucket", "fold").parquet(f"{self.root}/states")
        done = self.spark.createDataFrame([(number, b) for b in touched], "fold int, bucket int")
        done.coalesce(1).write.mode("append").parquet(f"{self.root}/folds")
        return sorted(touched)

    def _updated(self, new: DataFrame, old: DataFrame | None) -> DataFrame:
        """The states of buckets after a batch, shuffled once: merged where they are written."""
        if old is None:
            return new.repartition("bucket")
        return self._merged(new.unionByName(old).repartition("bucket"), "bucket")

    def _merged(self, states: DataFrame, *by: str) -> DataFrame:
        last = F.max(F.struct("ts", *EDGE_ATTRIBUTES)).alias("_last")
        return states.groupBy(*by, "source", "target").agg(last).select(
            *by, "source", "target", *[f"_last.{c}" for c in ("ts", *EDGE_ATTRIBUTES)]
        )

    def edges(self) -> DataFrame | None:
        """What ``collapse`` gives for all batches; None before the first."""
        states = self._states()
        return None if states is None else states.select("source", "target", *EDGE_ATTRIBUTES)


# --- one-hop questions -------------------------------------------------------

def direct(edges: DataFrame, node: str) -> DataFrame:
    """Immediate sources and targets of a node with the transform between."""
    attributes = ["transform", "stage"]
    sources = edges.where(F.col("target") == node).select(
        F.lit("source").alias("role"), F.col("source").alias("node"), *attributes
    )
    targets = edges.where(F.col("source") == node).select(
        F.lit("target").alias("role"), F.col("target").alias("node"), *attributes
    )
    return sources.unionByName(targets)


def transforms_touching(edges: DataFrame, node: str) -> DataFrame:
    """Distinct transforms that read or write a node."""
    touching = (F.col("source") == node) | (F.col("target") == node)
    return edges.where(touching).select("transform").distinct().orderBy("transform")


def impact(edges: DataFrame, node: str) -> DataFrame:
    """Everything downstream of a node: its descendants and the transforms involved.

    The transforms include those that produce the node itself.
    """
    downstream = settle(descendants(edges, node).select("node"), "downstream")
    start = edges.sparkSession.createDataFrame([(node,)], "node string")
    touched = downstream.unionByName(start)
    ends = edges.select(
        "transform", F.explode(F.array_distinct(F.array("source", "target"))).alias("node")
    )
    transforms = ends.join(touched, "node", "left_semi").select("transform").distinct()
    return downstream.select(F.lit("descendant").alias("kind"), F.col("node").alias("name")).unionByName(
        transforms.select(F.lit("transform").alias("kind"), F.col("transform").alias("name"))
    )


# --- layers and summary ------------------------------------------------------

def _layer(node: Column, without_dot: str) -> Column:
    parts = F.split(node, r"\.", 2)
    return F.when(F.size(parts) == 2, parts[0]).otherwise(F.lit(without_dot))


def _column(node: Column) -> Column:
    return F.element_at(F.split(node, r"\."), -1)


def nodes_by_layer(edges: DataFrame) -> DataFrame:
    """Nodes with their layer and its place in the pipeline; others come last."""
    layer = _layer(F.col("node"), "other")
    known = F.when(layer.isin(LAYER_ORDER), layer).otherwise(F.lit("other"))
    place = F.array_position(F.array(*[F.lit(x) for x in [*LAYER_ORDER, "other"]]), known)
    return nodes(edges).select(
        place.cast("int").alias("layer_order"), known.alias("layer"), "node"
    )


def _members(edges: DataFrame) -> DataFrame:
    """Distinct nodes, edges, layers, batches and transforms as (kind, name, other)."""
    graph = settle(collapse(edges), "graph")
    found = nodes_by_layer(graph)

    def rows(df: DataFrame, kind: str, name: str, other: Column | None = None) -> DataFrame:
        second = F.lit(None).cast("string") if other is None else other
        return df.select(F.lit(kind).alias("kind"), F.col(name).alias("name"), second.alias("other"))

    parts = [
        rows(found, "node", "node"),
        rows(found.where("layer != 'other'"), "layer", "layer"),
        rows(graph, "edge", "source", F.col("target")),
        rows(graph, "transform", "transform"),
        rows(edges, "batch", "batch_id"),
    ]
    return merge(*parts).distinct()


def summary(edges: DataFrame) -> DataFrame:
    """Node, edge, layer, batch and transform counts of the collapsed graph."""
    kinds = ["node", "edge", "layer", "batch", "transform"]
    return _members(edges).agg(
        *[F.count_if(F.col("kind") == k).alias(f"{k}_count") for k in kinds]
    )


def summary_members(edges: DataFrame) -> DataFrame:
    """The layers, batches and transforms behind the counts, as rows."""
    wanted = F.col("kind").isin("layer", "batch", "transform")
    return _members(edges).where(wanted).select("kind", "name")


# --- exports -----------------------------------------------------------------

def export_nodes(edges: DataFrame) -> DataFrame:
    return nodes(edges).select(
        F.col("node").alias("id"),
        _layer(F.col("node"), "unknown").alias("layer"),
        _column(F.col("node")).alias("column"),
    )


def export_edges(edges: DataFrame) -> DataFrame:
    """Collapsed edges with defaults for missing attributes."""
    unknown = {a: F.coalesce(F.col(a), F.lit("unknown")) for a in ("transform", "stage", "batch_id")}
    valid = F.try_parse_json("metadata").isNotNull()
    return collapse(edges).withColumns(
        {**unknown, "metadata": F.when(valid, F.col("metadata")).otherwise(F.lit("{}"))}
    )


def cytoscape_nodes(edges: DataFrame) -> DataFrame:
    colours = F.create_map(*[F.lit(x) for item in LAYER_COLOURS.items() for x in item])
    layer = _layer(F.col("node"), "other")
    return nodes(edges).select(
        F.col("node").alias("id"),
        _column(F.col("node")).alias("label"),
        layer.alias("layer"),
        F.coalesce(F.try_element_at(colours, layer), F.lit(DEFAULT_COLOUR)).alias("color"),
    )


def cytoscape_edges(edges: DataFrame) -> DataFrame:
    return collapse(edges).select(
        "source",
        "target",
        F.coalesce("transform", F.lit("")).alias("label"),
        F.coalesce("transform", F.lit("unknown")).alias("transform"),
        F.coalesce("stage", F.lit("unknown")).alias("stage"),
    )


def write_json(edges: DataFrame, path: str) -> None:
    """Nodes and edges as JSON lines in two folders, written by all tasks."""
    export_nodes(edges).write.json(f"{path}/nodes")
    export_edges(edges).write.json(f"{path}/edges")


def write_json_document(edges: DataFrame, path: str) -> None:
    """One document ``{"nodes": [...], "edges": [...]}`` as text parts that follow each other by name.

    Items are lines in the order of their names, range-partitioned, so that no task holds
    the document; the files read one after the other are the whole of it.
    """
    spark = edges.sparkSession
    items = [
        (1, settle(export_nodes(edges), "nodes"), ["id"]),
        (3, settle(export_edges(edges).withColumn("metadata", F.parse_json("metadata")), "edges"), ["source", "target"]),
    ]
    marks = [(0, None, None, '{"nodes": ['), (2, None, None, '], "edges": ['), (4, None, None, "]}")]
    lines = spark.createDataFrame(marks, "section int, a string, b string, line string")
    for section, rows, keys in items:
        a, b = (F.col(keys[0]), F.col(keys[1]) if len(keys) > 1 else F.lit(None).cast("string"))
        least = rows.agg(F.min(F.struct(*keys)).alias("least")).first().least
        first = F.lit(False) if least is None else same_values(dict(zip(keys, least)))
        line = F.concat(F.when(first, "").otherwise(","), F.to_json(F.struct(*rows.columns)))
        lines = lines.unionByName(rows.select(F.lit(section).alias("section"), a.alias("a"), b.alias("b"), line.alias("line")))
    order = [F.col(c).asc_nulls_first() for c in ("section", "a", "b")]
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.text(path)


def same_values(values: dict) -> Column:
    condition = F.lit(True)
    for name, value in values.items():
        condition = condition & F.col(name).eqNullSafe(F.lit(value))
    return condition


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Edges written by ``write_json``."""
    schema = "source string, target string, transform string, stage string, batch_id string, metadata string"
    return _with_defaults(spark.read.schema(schema).json(f"{path}/edges"))


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    """Edges of documents ``{"nodes": [...], "edges": [...]}``."""
    edge = (
        "struct<source:string,target:string,transform:string,stage:string,"
        "batch_id:string,metadata:variant>"
    )
    documents = spark.read.schema(f"edges array<{edge}>").option("multiLine", True).json(path)
    rows = documents.select(F.inline("edges")).withColumn("metadata", F.to_json("metadata"))
    return _with_defaults(rows)


def _with_defaults(rows: DataFrame) -> DataFrame:
    return rows.select(
        "source",
        "target",
        *[F.coalesce(a, F.lit("unknown")).alias(a) for a in ("transform", "stage", "batch_id")],
        F.coalesce("metadata", F.lit("{}")).alias("metadata"),
    )


def triples(edges: DataFrame) -> DataFrame:
    """The graph as N-Triples, one per row; an edge is named by its end points."""
    graph = export_edges(edges)
    subject = _iri("edge/", F.md5(F.concat_ws(" ", "source", "target")))
    statements = [
        (F.lit("<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>"), _iri("", F.lit("LineageEdge"))),
        (_iri("", F.lit("source")), _iri("column/", F.col("source"))),
        (_iri("", F.lit("target")), _iri("column/", F.col("target"))),
        (_iri("", F.lit("transform")), _text("transform")),
        (_iri("", F.lit("stage")), _text("stage")),
        (_iri("", F.lit("batchId")), _text("batch_id")),
    ]
    edge_rows = graph.select(F.explode(_lines(subject, statements)).alias("triple"))
    name = _iri("column/", F.col("id"))
    node_facts = [(_iri("", F.lit("layer")), _text("layer")), (_iri("", F.lit("column")), _text("column"))]
    node_rows = export_nodes(edges).select(F.explode(_lines(name, node_facts)).alias("triple"))
    return edge_rows.unionByName(node_rows)


def _lines(subject: Column, statements: list[tuple[Column, Column]]) -> Column:
    return F.array(
        *[F.concat(subject, F.lit(" "), p, F.lit(" "), o, F.lit(" .")) for p, o in statements]
    )


def _iri(kind: str, name: Column) -> Column:
    safe = F.replace(F.replace(name, F.lit(" "), F.lit("_")), F.lit("/"), F.lit("_"))
    return F.concat(F.lit(f"<{BASE_IRI}{kind}"), safe, F.lit(">"))


def _text(column: str) -> Column:
    escaped = F.col(column)
    for plain, code in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(code))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def write_triples(edges: DataFrame, path: str) -> None:
    triples(edges).write.text(path)
