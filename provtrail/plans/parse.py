"""Plan text to nodes, scopes and column edges, all inside the row of one plan.

A plan is the JSON text of an analyzed logical plan: a flat array of nodes in pre-order.
Everything here is a narrow transformation of native expressions, so a plan log of any
size is parsed without a shuffle; the text of one plan bounds the work of one row.

Vertices are strings unique within a plan: ``<scope>:<node>:<pos>`` for a column that a
node defines, with an ``S`` in front for a scanned column, ``<scope>:R:<pos>`` for an output
column of a subplan, ``<scope>:O:<id>`` for a column of the enclosing plan that a subplan refers
to, and ``cte:<id>:<pos>`` for a column of a common table expression. ``X:<class>:<scope>:<node>``
stands for whatever a node of unknown column flow gives, and ``X:unbound:<scope>:<node>`` for a
reference that none of the node's inputs has: a column that reaches one of these is tainted, and
all others of the plan are traced all the same. A column that only hands another one on (a bare
reference, alias or cast) is no vertex of its own: it points to the other's vertex, which keeps
edge tables small and paths short.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from provtrail.functions.binding import let
from provtrail.functions.ids import split_path
from provtrail.session import materialize

ELEM = ("struct<class: string, `num-children`: int, name: string, exprId: struct<id: bigint>, plan: string, dataType: string, "
        "e: array<struct<exprId: struct<id: bigint>>>>")
ATTRS = f"array<array<{ELEM}>>"
PLAN_SCHEMA = f"""array<struct<
    class: string, `num-children`: int,
    projectList: {ATTRS}, aggregateExpressions: {ATTRS}, windowExpressions: {ATTRS},
    output: {ATTRS}, generatorOutput: {ATTRS}, serializer: {ATTRS}, projections: array<{ATTRS}>, plan: string,
    generator: array<{ELEM}>, condition: array<{ELEM}>, right: array<{ELEM}>, asOfCondition: array<{ELEM}>,
    order: {ATTRS}, partitionSpec: {ATTRS}, orderSpec: {ATTRS}, groupingExpressions: {ATTRS},
    joinType: string, isTempView: boolean,
    identifier: struct<name: string, qualifier: string>,
    desc: struct<identifier: struct<table: string, database: string, catalog: string>>,
    id: bigint, cteId: bigint, outputAttrIds: array<struct<id: bigint>>>>"""

# Expression classes that hand values on unchanged or only choose between
# them. Every other class is a function, an aggregate or a window and makes its output
# column INDIRECT.
TRANSPARENT = (
    "Alias", "AttributeReference", "Literal", "OuterReference", "ScalarSubquery", "Exists",
    "InSubquery", "ListQuery", "Cast", "TryCast", "UpCast",
    "Coalesce", "Nvl", "NullIf", "Between", "With", "CommonExpressionRef", "CommonExpressionDef",
    "TypedNullLiteral", "In", "InSet", "Not", "IsNull", "IsNotNull", "CaseWhen", "If",
    "EqualTo", "EqualNullSafe", "LessThan", "LessThanOrEqual", "GreaterThan",
    "GreaterThanOrEqual", "And", "Or",
)
# Classes some of whose children carry no lineage (see _kept).
PARTIAL = ("AggregateExpression", "PivotFirst", "ScalarSubquery", "Exists", "ListQuery", "LateralSubquery")
SCANS = ("LogicalRelation", "LogicalRDD", "LocalRelation", "DataSourceV2Relation", "Range",
         "HiveTableRelation", "StreamingRelation", "StreamingRelationV2")
LEAF = "S"  # first letter of the vertices of scanned columns
TAINT = "X"  # first letter of the vertices of unknown columns
DEFINITION = -1  # id of the plan that a node holds itself, such as the query of CREATE VIEW
SET_OPS = ("Union", "Intersect", "Except")
# Nodes that hand on all columns of their (first) child. A node of any other class taints the columns
# that come from it: its text does not tell how columns flow through it.
PASS_THROUGH = (
    "Filter", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Tail", "Sample", "Distinct", "Deduplicate",
    "DeduplicateWithinWatermark", "SubqueryAlias", "View", "Repartition", "RepartitionByExpression",
    "RebalancePartitions", "ResolvedHint", "CollectMetrics", "EventTimeWatermark", "WithCTE", "CTERelationDef",
    "CTERelationRef", "UnionLoop", "UnionLoopRef", "OneRowRelation", "EmptyRelation", "PipeOperator",
    "CreateViewCommand", "InsertIntoHadoopFsRelationCommand", "InsertIntoStatement", "CreateDataSourceTableAsSelectCommand",
    "SaveIntoDataSourceCommand", "CreateTableAsSelect", "ReplaceTableAsSelect", "AppendData", "OverwriteByExpression",
    "SetCommand", "DropTableCommand", "DropTempViewCommand", "AlterTableRenameCommand")
SCOPES = ("Project", "Aggregate", "Expand")
JOINS = ("Join", "AsOfJoin", "LateralJoin")
KNOWN = (*PASS_THROUGH, *SCOPES, *SET_OPS, *SCANS, *JOINS, "Window", "Generate")

PTR = "struct<id: bigint, name: string, v: string>"
REFS = "struct<refs: array<bigint>, breaks: boolean, subs: array<bigint>>"


def short(col: Column) -> Column:
    return F.substring_index(col, ".", -1)


def _fold(items: Column, entry_type: str, merge) -> Column:
    """Fold a pre-order array bottom-up: ``merge(kids, item)`` gives the entry of an item.

    Walking backwards, the entries of an item's children are the top of the stack.
    """
    def step(stack, item):
        n = item["num-children"]
        entry = let(F.slice(stack, 1, n), lambda kids: merge(kids, item))
        return F.concat(F.array(entry), F.slice(stack, n + 1, F.size(stack)))

    return F.aggregate(F.reverse(items), F.array().cast(f"array<{entry_type}>"), step)


def _kept(kids: Column, elem: Column) -> Column:
    """Children of an expression that carry lineage.

    The FILTER of an aggregate (its second child), the pivot column of PivotFirst and the
    outer columns listed under a subquery do not.
    """
    cls = short(elem["class"])
    return (
        F.when(cls == "AggregateExpression", F.slice(kids, 1, 1))
        .when(cls == "PivotFirst", F.slice(kids, 2, 1))
        .when(cls.isin("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"), F.slice(kids, 1, 0))
        .otherwise(kids)
    )


def _reference(elem: Column) -> Column:
    """Id that an element refers to, null if none; a column of the enclosing plan counts as -1 - id."""
    cls = short(elem["class"])
    return F.when(cls == "AttributeReference", elem["exprId"]["id"]).when(
        cls == "OuterReference", -1 - F.get(elem["e"], F.lit(0))["exprId"]["id"])


def _own_refs(elem: Column) -> Column:
    return let(_reference(elem), lambda r: F.when(r.isNotNull(), F.array(r)).otherwise(F.array().cast("array<bigint>")))


def _own_subs(elem: Column) -> Column:
    return F.when(short(elem["class"]) == "ScalarSubquery", F.array(elem["exprId"]["id"])).otherwise(
        F.array().cast("array<bigint>"))


def expression_refs(elems: Column) -> Column:
    """References, DIRECT-breaking flag and scalar subqueries of one flat expression."""
    def merge(kids, elem):
        return let(_kept(kids, elem), lambda k: F.struct(
            F.concat(F.flatten(F.transform(k, lambda e: e["refs"])), _own_refs(elem)).alias("refs"),
            (F.exists(k, lambda e: e["breaks"]) | ~short(elem["class"]).isin(*TRANSPARENT)).alias("breaks"),
            F.concat(F.flatten(F.transform(k, lambda e: e["subs"])), _own_subs(elem)).alias("subs"),
        ))

    exact = let(F.element_at(_fold(elems, REFS, merge), 1), lambda r: r.withField("refs", F.array_distinct(r["refs"])))
    simple = _all_refs(elems)
    partial = F.exists(elems, lambda e: short(e["class"]).isin(*PARTIAL))
    return F.when(partial, exact).otherwise(simple)


def _all_refs(elems: Column) -> Column:
    """As ``expression_refs`` for elements of one or several expressions, all of which carry lineage."""
    return F.struct(
        F.array_distinct(F.array_compact(F.transform(elems, _reference))).alias("refs"),
        F.exists(elems, lambda e: ~short(e["class"]).isin(*TRANSPARENT)).alias("breaks"),
        F.array().cast("array<bigint>").alias("subs"),
    )


# Type names of the plan text that differ from Spark SQL's.
TYPE_NAMES = {"long": "bigint", "integer": "int", "short": "smallint", "byte": "tinyint"}


def simple_type(text: Column) -> Column:
    """Type of the plan text as Spark SQL writes it; nested types stay JSON."""
    out = text
    for name, simple in TYPE_NAMES.items():
        out = F.when(text == name, simple).otherwise(out)
    return out


def _vertex(scope: Column, node: Column, pos: Column) -> Column:
    return F.concat_ws(":", scope, node.cast("string"), pos.cast("string"))


def _ptrs(attrs: Column, scope: Column, nid: Column) -> Column:
    """Pointers for an attribute list that node ``nid`` defines."""
    return F.transform(attrs, lambda a, i: F.struct(
        a[0]["exprId"]["id"].alias("id"), a[0]["name"].alias("name"), _vertex(scope, nid, i).alias("v")))


def _describe(n: Column, i: Column, scope: Column, inner: Column, columns: bool = True) -> Column:
    """What a node defines by itself, before looking at its children.

    ``inner`` maps embedded plans by id to their outputs. Without ``columns`` only scans define some.
    """
    cls = short(n["class"])
    unknown = ~cls.isin(*KNOWN)
    attrs = F.coalesce(n["projectList"], n["aggregateExpressions"], n["windowExpressions"],
                       n["generatorOutput"], n["output"], n["serializer"])
    own = F.when(
        cls == "UnionLoop",
        F.transform(n["outputAttrIds"], lambda a, p: F.struct(
            a["id"].alias("id"), F.lit(None).cast("string").alias("name"), _vertex(scope, i, p).alias("v"))),
    ).otherwise(_ptrs(
        attrs, F.when(cls == "CTERelationRef", F.lit("cte")).when(cls.isin(*SCANS), F.concat(F.lit(LEAF), scope)).otherwise(scope),
        F.when(cls == "CTERelationRef", n["cteId"]).otherwise(i)))
    embedded = F.when(cls == "LateralJoin", F.filter(n["right"], lambda e: e["plan"].isNotNull())[0]["exprId"]["id"]).when(
        cls == "CreateViewCommand", F.lit(DEFINITION))
    own = F.when(embedded.isNotNull(), _inner_columns(embedded, inner, scope)).when(
        unknown, F.transform(own, lambda p: p.withField("v", _tainted(cls, scope, i)))).otherwise(own)
    exprs = F.when(cls == "Generate", F.transform(n["generatorOutput"], lambda _: n["generator"])).otherwise(
        F.coalesce(n["projectList"], n["aggregateExpressions"], n["windowExpressions"]))
    refs = F.when(cls == "Expand", F.transform(n["output"], lambda _, p: _all_refs(F.flatten(
        F.transform(n["projections"], lambda one: F.get(one, p)))))).otherwise(F.transform(exprs, expression_refs))
    if not columns:
        own = F.when(cls.isin(*SCANS), own)
        refs = F.lit(None).cast(f"array<{REFS}>")
    semi = n["joinType"].rlike("LeftSemi|LeftAnti|ExistenceJoin")
    return F.struct(
        i.alias("nid"),
        cls.alias("cls"),
        # Without its lists an Expand does not tell what it does.
        (unknown | ((cls == "Expand") & n["projections"].isNull())).alias("unknown"),
        n["num-children"].alias("num-children"),
        F.when(unknown, "unknown").when(cls.isin(*SCOPES) | (n["num-children"] == 0) | (cls == "UnionLoop"), "own")
        .when(cls.isin("Window", "Generate"), "append")
        .when(cls.isin("Join", "AsOfJoin") & ~semi, "concat")
        .when(cls == "LateralJoin", "append")
        .when(cls.isin(*SET_OPS), "setop")
        .when(cls == "WithCTE", "last")
        .otherwise("first").alias("mode"),
        own.alias("own"),
        refs.alias("exprs"),
        F.filter(_subplans_of(n), lambda p: p["flows"]).alias("calls"),
        F.coalesce(n["cteId"], n["id"]).alias("cte"),
        F.when((cls == "View") & n["desc"].isNotNull(), F.concat_ws(
            ".", n["desc"]["identifier"]["catalog"], n["desc"]["identifier"]["database"],
            n["desc"]["identifier"]["table"])).alias("view_name"),
        # A table of a catalog: the alias above its scan has a qualifier, "[catalog, schema]".
        F.when((cls == "SubqueryAlias") & (n["identifier"]["qualifier"] != "[]"), F.concat_ws(
            ".", F.split(F.regexp_replace(n["identifier"]["qualifier"], r"[\[\]\s\"]", ""), ","),
            n["identifier"]["name"])).alias("table_name"),
        n["joinType"].alias("join_type"),
        F.when(n["num-children"] == 0, F.transform(n["output"], lambda a: F.struct(
            a[0]["name"].alias("name"), simple_type(a[0]["dataType"]).alias("type")))).alias("fields"),
        cls.isin(*SCANS).alias("is_scan"),
    )


def _tainted(cls: Column, scope: Column, nid: Column) -> Column:
    return F.concat_ws(":", F.lit(TAINT), cls, scope, nid.cast("string"))


def _inner_columns(embedded: Column, inner: Column, scope: Column) -> Column:
    """Columns that a node takes from a plan embedded in it: pointers to that plan's outputs."""
    return F.transform(inner[embedded], lambda o, i: F.struct(
        o["id"].alias("id"), o["name"].alias("name"),
        _vertex(F.concat_ws("/", scope, embedded.cast("string")), F.lit("R"), i).alias("v")))


EDGES = "array<struct<src: string, dst: string, breaks: boolean>>"
NODE_FOLD = f"""struct<nid: int, size: int, out: array<{PTR}>,
    done: array<struct<nid: int, size: int, kids: array<int>, scope: array<array<{PTR}>>>>>"""


def _plain(expr: Column) -> Column:
    """An expression that only hands on one column."""
    return (F.size(expr["refs"]) == 1) & ~expr["breaks"] & (F.size(expr["subs"]) == 0)


def _bind(desc: Column) -> Column:
    """Visible columns of every node: one bottom-up pass over the described nodes."""
    empty = F.array().cast(f"array<{PTR}>")

    def merge(kids, d):
        outs = F.transform(kids, lambda k: k["out"])
        return let(F.coalesce(F.get(kids, F.lit(0))["out"], empty), lambda first: bound(kids, first, outs, d))

    def bound(kids, first, outs, d):
        mode = d["mode"]
        out = (
            F.when(d["cls"].isin(*SCOPES), let(F.transform(first, lambda p: p["id"]), lambda known: F.transform(
                F.arrays_zip(d["own"].alias("o"), d["exprs"].alias("e")),
                lambda z: F.when(
                    _plain(z["e"]) & F.array_contains(known, z["e"]["refs"][0]),
                    F.struct(
                        z["o"]["id"].alias("id"), z["o"]["name"].alias("name"),
                        F.get(first, (F.array_position(known, z["e"]["refs"][0]) - 1).cast("int"))["v"].alias("v")),
                ).otherwise(z["o"]))))
            .when(mode == "own", F.coalesce(d["own"], empty))
            # What is known of an unknown node's columns are their names at best.
            .when(mode == "unknown", F.when(F.size(d["own"]) > 0, d["own"]).otherwise(
                F.transform(F.flatten(outs), lambda p: p.withField("v", d["taint"]))))
            .when(mode == "append", F.concat(first, F.coalesce(d["own"], empty)))
            .when(mode == "concat", F.flatten(outs))
            .when(mode == "setop", F.transform(first, lambda o, p: F.struct(
                o["id"].alias("id"), o["name"].alias("name"),
                F.concat(d["prefix"], p.cast("string")).alias("v"))))
            .when(mode == "last", F.coalesce(F.element_at(kids, -1)["out"], empty))
            .otherwise(first)
        )
        size = F.aggregate(kids, F.lit(1), lambda a, k: a + k["size"])
        mine = F.struct(
            d["nid"].alias("nid"), size.alias("size"),
            F.transform(kids, lambda k: k["nid"]).alias("kids"),
            F.when(mode.isin("own", "append", "setop") | (d["cls"] == "CTERelationDef"), outs).alias("scope"))
        return F.struct(
            d["nid"].alias("nid"), size.alias("size"), out.alias("out"),
            F.concat(F.array(mine), F.flatten(F.transform(kids, lambda k: k["done"]))).alias("done"))

    return F.element_at(_fold(desc, NODE_FOLD, merge), 1)


SHAPE_FOLD = "struct<nid: int, size: int, done: array<struct<nid: int, size: int, kids: array<int>>>>"


def _shape(desc: Column) -> Column:
    """Sizes and children of every node, without columns."""
    def merge(kids, d):
        size = F.aggregate(kids, F.lit(1), lambda a, k: a + k["size"])
        mine = F.struct(d["nid"].alias("nid"), size.alias("size"), F.transform(kids, lambda k: k["nid"]).alias("kids"))
        return F.struct(d["nid"].alias("nid"), size.alias("size"), F.concat(
            F.array(mine), F.flatten(F.transform(kids, lambda k: k["done"]))).alias("done"))

    return F.element_at(_fold(desc, SHAPE_FOLD, merge), 1)


# What a parse can give besides subplans, readable and unknown, which it always gives.
RESULTS = ("nodes", "scans", "edges", "outputs")
COLUMNS = ("edges", "outputs")


def _parse(plans: DataFrame, wanted: tuple[str, ...] = RESULTS) -> DataFrame:
    """Parse (sub)plans: plan_id, scope, plan_json, files, inner. Narrow: no shuffle.

    What comes back per plan is compact: its nodes, scans, column edges and output columns,
    and the text of the plans embedded in its expressions. ``again`` is the text of a plan that
    takes columns from embedded plans, as long as ``inner`` does not tell these.
    """
    columns, results = _parse_steps(any(r in wanted for r in COLUMNS))
    for name, column in columns:
        plans = plans.withColumn(name, column)
    return plans.select("plan_id", "scope", *[
        c.alias(name) for name, c in results.items() if name in wanted or name not in RESULTS])


def _parse_steps(columns_wanted: bool) -> tuple[list[tuple[str, Column]], dict[str, Column]]:
    """Expressions of ``_parse``: intermediate columns in order, then the results by name."""
    scope = F.col("scope")
    columns = [
        ("raw", F.from_json("plan_json", PLAN_SCHEMA)),
        ("desc", F.transform("raw", lambda n, i: _describe(n, i, scope, F.col("inner"), columns_wanted).withField(
            "prefix", F.concat_ws(":", scope, i.cast("string"), F.lit(""))).withField(
            "taint", _tainted(short(n["class"]), scope, i)))),
        ("subplans", F.flatten(F.transform("raw", _subplans_of))),
        ("bound", F.when(F.size("desc") > 0, (_bind if columns_wanted else _shape)(F.col("desc")))),
        ("leaves", F.transform(F.filter("desc", lambda d: d["num-children"] == 0), lambda d: d["nid"])),
    ]
    results = {
        "subplans": F.col("subplans"),
        "readable": F.coalesce((F.size("desc") > 0) & F.forall("desc", lambda d: d["cls"].isNotNull()), F.lit(False)),
        "nodes": F.transform("bound.done", lambda b: let(F.get("desc", b["nid"]), lambda d: F.struct(
            b["nid"].alias("nid"), b["size"].alias("size"), b["kids"].alias("kids"), d["cls"].alias("cls"),
            d["view_name"].alias("view_name"), d["join_type"].alias("join_type")))),
        "scans": F.transform(F.filter("desc", lambda d: d["is_scan"]), lambda d: F.struct(
            d["nid"].alias("nid"), d["cls"].alias("cls"), d["own"].alias("own"),
            d["fields"].alias("fields"), F.coalesce(_stand_in(d["nid"], "table_name"), _stand_in(d["nid"], "view_name")).alias("known_as"),
            F.get(F.filter("files", lambda f: f["leaf"] == F.array_position("leaves", d["nid"]) - 1),
                  F.lit(0))["paths"].alias("paths"))),
        "unknown": F.get(F.filter("desc", lambda d: d["unknown"]), F.lit(0))["cls"],
    }
    if columns_wanted:
        edges = F.transform("bound.done", lambda b: let(
            F.get("desc", b["nid"]), lambda d: _edges_of(b["nid"], b["scope"], d, scope)))
        roots = F.transform("bound.out", lambda p, i: _edge(_vertex(scope, F.lit("R"), i), p["v"]))
        waits = F.exists("desc", lambda d: d["cls"].isin("LateralJoin", "CreateViewCommand")) & F.col("inner").isNull()
        results |= {
            "edges": F.concat(F.flatten(edges), F.when(scope != "0", roots).otherwise(F.array().cast(EDGES))),
            "outputs": F.transform("bound.out", lambda p: F.struct(
                p["id"].alias("id"), p["name"].alias("name"), p["v"].alias("v"))),
            "again": F.when(waits, F.struct("plan_json", "files"))}
    return columns, results


SUBPLANS = "array<struct<id: bigint, plan_json: string, outer: array<bigint>, flows: boolean>>"


def _subplans_of(n: Column) -> Column:
    """Plans embedded in a node or its expressions: id, plan_json, the columns of the node's input
    that they refer to, and whether values flow out of them."""
    lists = [F.coalesce(n[k], F.array().cast(ATTRS)) for k in (
        "projectList", "aggregateExpressions", "windowExpressions", "order", "partitionSpec", "orderSpec", "groupingExpressions")]
    single = [F.coalesce(n[k], F.array().cast(f"array<{ELEM}>")) for k in ("condition", "generator", "right", "asOfCondition")]
    none = F.array().cast("array<bigint>")

    # The columns of the input that a subquery refers to are its children: leaves right behind it.
    def found(elems):
        return F.array_compact(F.transform(elems, lambda e, i: F.when(e["plan"].isNotNull(), F.struct(
            e["exprId"]["id"].alias("id"), e["plan"].alias("plan_json"),
            F.array_compact(F.transform(F.slice(elems, i + 2, e["num-children"]), _reference)).alias("outer"),
            short(e["class"]).isin("ScalarSubquery", "LateralSubquery").alias("flows")))))

    held = F.struct(F.lit(DEFINITION).cast("bigint").alias("id"), n["plan"].alias("plan_json"), none.alias("outer"), F.lit(False).alias("flows"))
    return F.concat(
        let(F.concat(*[F.flatten(x) for x in lists], *single), found),
        F.when((short(n["class"]) == "CreateViewCommand") & n["plan"].isNotNull(), F.array(held)).otherwise(F.array().cast(SUBPLANS)))


def _stand_in(nid: Column, field: str) -> Column:
    """Name carried by the View / SubqueryAlias nodes directly above a scan leaf: the lowest."""
    above = F.reverse(F.filter("desc", lambda d: d["nid"] < nid))
    found = F.aggregate(
        above, F.struct(F.lit(True).alias("open"), F.lit(None).cast("string").alias("name")),
        lambda a, d: let(a["open"] & d["cls"].isin("View", "SubqueryAlias"), lambda ok: F.struct(
            ok.alias("open"), F.when(ok, F.coalesce(a["name"], d[field])).otherwise(a["name"]).alias("name"))))
    return found["name"]


def _edge(src: Column, dst: Column, breaks: Column | None = None) -> Column:
    return F.struct(src.alias("src"), dst.alias("dst"),
                    (F.lit(False) if breaks is None else breaks).alias("breaks"))


def _lookup(visible: Column, ids: Column, scope: Column, nid: Column) -> Column:
    """Vertices of the visible columns with the given ids, and of columns of the enclosing plan.

    What is not visible at all is tainted rather than lost.
    """
    return let(F.transform(visible, lambda p: p["id"]), lambda known: F.transform(ids, lambda r: (
        F.when(r < 0, _vertex(scope, F.lit("O"), -1 - r))
        .when(F.array_contains(known, r), F.get(visible, (F.array_position(known, r) - 1).cast("int"))["v"])
        .otherwise(_tainted(F.lit("unbound"), scope, nid)))))


def _edges_of(nid: Column, kid_cols: Column, d: Column, scope: Column) -> Column:
    """Column edges that one node contributes."""
    def from_exprs(visible):
        return let(F.transform(visible, lambda p: p["id"]), lambda known: F.flatten(F.transform(
            F.arrays_zip(d["own"].alias("o"), d["exprs"].alias("e")),
            lambda z: F.transform(
                F.concat(
                    F.when(_plain(z["e"]) & d["cls"].isin(*SCOPES) & F.array_contains(known, z["e"]["refs"][0]),
                           F.array().cast("array<string>")).otherwise(_lookup(visible, z["e"]["refs"], scope, nid)),
                    F.transform(z["e"]["subs"], lambda s: F.concat_ws(
                        ":", F.concat_ws("/", scope, s.cast("string")), F.lit("R"), F.lit("0")))),
                lambda dst: _edge(z["o"]["v"], dst, z["e"]["breaks"])))))

    # The columns that embedded plans refer to, under the names these plans have for them.
    def from_calls(visible):
        return F.flatten(F.transform(d["calls"], lambda c: F.transform(
            F.arrays_zip(c["outer"].alias("id"), _lookup(visible, c["outer"], scope, nid).alias("v")),
            lambda z: _edge(_vertex(F.concat_ws("/", scope, c["id"].cast("string")), F.lit("O"), F.when(
                z["id"] < 0, -1 - z["id"]).otherwise(z["id"])), z["v"]))))

    # The recursive branch of a loop refers to the loop itself: only the anchor counts.
    branches = F.when(d["cls"] == "UnionLoop", F.slice(kid_cols, 1, 1)).otherwise(kid_cols)
    by_position = F.flatten(F.transform(branches, lambda cols: F.transform(
        cols, lambda p, i: _edge(_vertex(scope, nid, i), p["v"]))))
    none = F.array().cast(EDGES)
    own = (
        F.when(d["cls"].isin(*SCOPES, "Window", "Generate"), let(F.flatten(kid_cols), from_exprs))
        .when(d["cls"].isin(*SET_OPS, "UnionLoop"), by_position)
        .when(d["cls"] == "CTERelationDef", F.transform(
            F.get(kid_cols, F.lit(0)), lambda p, i: _edge(_vertex(F.lit("cte"), d["cte"], i), p["v"])))
        .otherwise(none)
    )
    called = F.when((F.size(d["calls"]) > 0) & kid_cols.isNotNull(), let(F.flatten(kid_cols), from_calls)).otherwise(none)
    return F.concat(own, called)


FILES = "array<struct<leaf: int, paths: array<string>>>"


def parse_plans(plans: DataFrame, keep_broken: bool = False, wanted: tuple[str, ...] = RESULTS) -> DataFrame:
    """Parse plans and the plans embedded in their expressions.

    ``plans``: plan_id, plan_json, optionally files. One row per (sub)plan comes back:
    plan_id, scope, nodes, scans, edges, outputs, readable, unknown (a node class of unknown column
    flow). ``wanted`` leaves out nodes, scans, edges or outputs, which are then neither computed nor
    written; without the last two no columns are bound at all. Texts that are no plan are left out
    unless ``keep_broken``. The plan texts are read once: embedded plans come out with their parent's
    row and are parsed as the next level. Only a plan that takes columns from a plan embedded in it
    is parsed a second time, once that one's outputs are known, from the innermost level on. Each
    level is a written table, so later jobs read only the columns they need.
    """
    if "files" not in plans.columns:
        plans = plans.withColumn("files", F.lit(None).cast(FILES))
    unbound = F.lit(None).cast(INNER).alias("inner")
    level = plans.select("plan_id", F.lit("0").alias("scope"), "plan_json", "files", unbound)
    levels = []
    while True:
        written = materialize(_parse(level, wanted), "parsed")
        levels.append(written)
        inner = written.select("plan_id", "scope", F.explode("subplans").alias("s"))
        if inner.isEmpty():
            break
        level = inner.select(
            "plan_id", F.concat_ws("/", "scope", F.col("s.id").cast("string")).alias("scope"),
            F.col("s.plan_json").alias("plan_json"), F.lit(None).cast(FILES).alias("files"), unbound)
    if any(r in wanted for r in COLUMNS):
        for i in range(len(levels) - 2, -1, -1):
            levels[i] = _bound_again(levels[i], levels[i + 1], wanted)
    parsed = reduce(DataFrame.unionByName, [one.drop("subplans", "again") for one in levels])
    # Filtering before the write would make Spark parse every plan twice.
    return parsed if keep_broken else parsed.filter("readable")


INNER = "map<bigint, array<struct<id: bigint, name: string>>>"


def _bound_again(level: DataFrame, below: DataFrame, wanted: tuple[str, ...]) -> DataFrame:
    """Parse anew the plans of a level that take columns from plans embedded in them (lateral joins,
    view definitions), now that the outputs of these are bound."""
    waiting = level.filter("again is not null").select("plan_id", "scope", "again.*")
    if waiting.isEmpty():
        return level
    outputs = below.filter("outputs is not null").select(
        "plan_id", F.regexp_extract("scope", r"^(.*)/(-?\d+)$", 1).alias("scope"),
        F.regexp_extract("scope", r"/(-?\d+)$", 1).cast("bigint").alias("_id"),
        F.transform("outputs", lambda o: F.struct(o["id"].alias("id"), o["name"].alias("name"))).alias("_columns"))
    # A plan embeds a bounded number of plans: its own text does.
    known = outputs.join(waiting.select("plan_id", "scope"), ["plan_id", "scope"], "left_semi").groupBy("plan_id", "scope").agg(
        F.map_from_entries(F.collect_list(F.struct("_id", "_columns"))).alias("inner"))
    given = waiting.join(known, ["plan_id", "scope"], "left").withColumn("inner", F.coalesce("inner", F.create_map().cast(INNER)))
    again = materialize(_parse(given, wanted), "bound")
    return level.filter("again is null").unionByName(again)


def plan_nodes(parsed: DataFrame) -> DataFrame:
    """One row per node: plan_id, scope, nid (pre-order), size of its subtree, kids, cls,
    view_name, join_type."""
    return parsed.select("plan_id", "scope", F.explode("nodes").alias("n")).select("plan_id", "scope", "n.*")


def scan_leaves(parsed: DataFrame, default_namespace: str) -> DataFrame:
    """Scans with their dataset: plan_id, scope, nid, own and fields (columns), dataset, paths.

    A table, or a view that only stands for its scan, names the dataset; otherwise the
    first file does; a scan with neither is (``file``, node class).
    """
    return (
        parsed.select("plan_id", "scope", F.explode("scans").alias("s")).select("plan_id", "scope", "s.*")
        .withColumn(
            "dataset",
            F.when(F.col("known_as").isNotNull(), F.struct(
                F.lit(default_namespace).alias("namespace"), F.col("known_as").alias("name")))
            .when(F.size("paths") > 0, split_path(F.get("paths", F.lit(0))))
            .otherwise(F.struct(F.lit("file").alias("namespace"), F.col("cls").alias("name"))))
    )


def column_edges(parsed: DataFrame) -> DataFrame:
    """Edges between column vertices: plan_id, src, dst, breaks, terminal (dst is scanned or unknown)."""
    return parsed.select("plan_id", F.explode("edges").alias("e")).select(
        "plan_id", "e.*", F.substring("e.dst", 1, 1).isin(LEAF, TAINT).alias("terminal"))


def root_columns(parsed: DataFrame) -> DataFrame:
    """Output columns of every top-level plan: plan_id, ordinal, out_col, v."""
    return parsed.filter(F.col("scope") == "0").select(
        "plan_id", F.posexplode("outputs").alias("ordinal", "o")).select(
        "plan_id", "ordinal", F.col("o.name").alias("out_col"), F.col("o.v").alias("v"))


def leaf_sources(scans: DataFrame) -> DataFrame:
    """Columns of scans as sources: plan_id, v, source (namespace, name, field)."""
    return scans.select("plan_id", "dataset", F.explode("own").alias("p")).select(
        "plan_id", F.col("p.v").alias("v"),
        F.struct(
            F.col("dataset.namespace").alias("namespace"), F.col("dataset.name").alias("name"),
            F.col("p.name").alias("field")).alias("source"))
