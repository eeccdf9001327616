"""Landed documents to rows: nested facts, unit buckets, instance XML, venue records, wide prices, filing arrays."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_FACT = "struct<fy:int,fp:string,form:string,start:date,end:date,val:double,filed:date,accn:string>"
FACTS_SCHEMA = f"entity string, facts map<string,map<string,struct<units:map<string,array<{_FACT}>>>>>"


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the form namespace -> tag -> units -> [facts]."""
    return spark.read.schema(FACTS_SCHEMA).option("multiLine", True).json(path)


def preferred_unit(units: Column, wanted: Sequence[str] = ("USD", "USD/shares", "shares")) -> Column:
    """The first wanted unit that is there, else the one with most facts (the least name of ties)."""
    present = [F.when(F.map_contains_key(units, w), F.lit(w)) for w in wanted]
    sized = F.transform(F.map_keys(units), lambda k: F.struct((-F.size(F.element_at(units, k))).alias("n"), k.alias("k")))
    return F.coalesce(*present, F.array_min(sized)["k"])


def explode_facts(docs: DataFrame) -> DataFrame:
    """A row per fact of each tag's preferred unit."""
    tags = docs.select("entity", F.explode("facts").alias("namespace", "tags")).select("entity", "namespace", F.explode("tags").alias("tag", "body"))
    chosen = tags.withColumn("unit", preferred_unit(F.col("body.units")))
    facts = chosen.select("entity", "namespace", "tag", "unit", F.explode(F.element_at("body.units", F.col("unit"))).alias("f"))
    return facts.select("entity", "namespace", "tag", "unit", "f.*")


def current_facts(facts: DataFrame, entity: Column, period_end: Column) -> DataFrame:
    """Facts with exactly the four base dimensions, of the entity and the current period (it ends a day later), numeric."""
    d = F.col("dimensions")
    base = F.array_sort(F.map_keys(d)) == F.array(*[F.lit(x) for x in ("concept", "entity", "period", "unit")])
    end = F.to_date(F.element_at(F.split(d["period"], "/"), -1).substr(1, 10))
    number = F.col("value").try_cast("double")
    return facts.filter(base & (d["entity"] == entity) & (end == F.date_add(period_end, 1)) & number.isNotNull()).select(d["concept"].alias("concept"), number.alias("value"), d["unit"].alias("unit"))


def merge_entities(*facts: DataFrame) -> DataFrame:
    """Facts of an entity and its predecessors in one frame by name, with ``rank`` 0 for the first (a later choice prefers it); absent columns are null."""
    ranked = [f.withColumn("rank", F.lit(k)) for k, f in enumerate(facts)]
    out = ranked[0]
    for f in ranked[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def member_facts(facts: DataFrame, axis: str, members: Sequence[str]) -> DataFrame:
    """Facts with just one dimension, whose member is one of those allowed. Takes ``dims map<string,string>``."""
    only = facts.filter((F.size("dims") == 1) & F.map_contains_key("dims", F.lit(axis)))
    return only.filter(F.element_at("dims", F.lit(axis)).isin(*members)).withColumn("member", F.element_at("dims", F.lit(axis)))


def presented_lines(arcs: DataFrame, labels: DataFrame, facts: DataFrame) -> DataFrame:
    """Lines of a filing as presented: arcs (role, parent, tag, order, preferred) with the label of the preferred role, else the
    standard one, and the fact's value; ``negated`` where the preferred label says so. Lines without a fact stay."""
    own = labels.select("tag", F.col("role").alias("preferred"), F.col("label").alias("__own"))
    plain = labels.filter("role = 'label'").select("tag", F.col("label").alias("__plain"))
    lines = arcs.join(own, ["tag", "preferred"], "left").join(plain, "tag", "left").withColumn("label", F.coalesce("__own", "__plain", "tag"))
    negated = F.coalesce(F.startswith(F.lower("preferred"), F.lit("negated")), F.lit(False))
    return lines.join(facts, "tag", "left").select("role", "parent", "tag", "order", "label", negated.alias("negated"), *[c for c in facts.columns if c != "tag"])


_SHEET = "{urn:schemas-microsoft-com:office:spreadsheet}"


def sheet_rows(text: str) -> list[list[str]]:
    """Rows of the first sheet of an XML workbook, cells that are skipped by an index as empty."""
    import xml.etree.ElementTree as xml

    table = xml.fromstring(text).find(f"{_SHEET}Worksheet/{_SHEET}Table")
    out = []
    for row in table.findall(f"{_SHEET}Row") if table is not None else ():
        cells: list[str] = []
        for cell in row.findall(f"{_SHEET}Cell"):
            at = cell.get(f"{_SHEET}Index")
            cells += [""] * (int(at) - 1 - len(cells) if at else 0)
            cells.append("".join(cell.itertext()).strip())
        out.append(cells)
    return out


def table_rows(html: str, wanted: Sequence[str]) -> list[dict[str, str]]:
    """Rows of the first HTML table whose header has all wanted names."""
    from html.parser import HTMLParser

    class Tables(HTMLParser):
        def __init__(self) -> None:
            super().__init__()
            self.tables: list[list[list[str]]] = []
            self.open = False

        def handle_starttag(self, tag, attrs):
            if tag == "table":
                self.tables.append([])
            elif tag == "tr" and self.tables:
                self.tables[-1].append([])
            elif tag in ("td", "th") and self.tables and self.tables[-1]:
                self.tables[-1][-1].append("")
                self.open = True

        def handle_endtag(self, tag):
            self.open = self.open and tag not in ("td", "th", "tr", "table")

        def handle_data(self, data):
            if self.open:
                self.tables[-1][-1][-1] += data

    parser = Tables()
    parser.feed(html)
    for rows in parser.tables:
        head = [c.strip() for c in rows[0]] if rows else []
        if set(wanted) <= set(head):
            return [dict(zip(head, (c.strip() for c in r), strict=False)) for r in rows[1:] if r]
    return []


def made_facts(spark: SparkSession, tickers: int, years: Sequence[int], concepts: Sequence[str], seed: int = 1) -> DataFrame:
    """A reproducible frame of yearly facts for tests and demos: every value from a hash of its key and the seed."""
    ids = spark.range(tickers).select(F.concat(F.lit("T"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("ticker"))
    grid = ids.select("ticker", F.explode(F.array(*map(F.lit, years))).alias("fiscal_year")).select("*", F.explode(F.array(*map(F.lit, concepts))).alias("concept"))
    value = (F.pmod(F.xxhash64("ticker", "fiscal_year", "concept", F.lit(seed)), F.lit(1_000_000)) / 100).alias("value")
    return grid.select("ticker", "fiscal_year", "concept", F.make_date("fiscal_year", F.lit(12), F.lit(31)).alias("period_end"), value)


def class_totals(facts: DataFrame, axis: str = "StatementClassOfStockAxis") -> DataFrame:
    """Sum over the members of one axis at each entity's latest instant; facts with other dimensions are left out.

    Takes ``entity, instant, dims map<string,string>, value``.
    """
    only = facts.filter((F.size("dims") == 1) & F.map_contains_key("dims", F.lit(axis)))
    newest = F.max("instant").over(Window.partitionBy("entity"))
    return only.withColumn("n", newest).filter("instant = n").groupBy("entity", "instant").agg(F.sum("value").alias("value"))


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Rows of an XML document by tag, read by Spark's own source in splits."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def tidy_prices(df: DataFrame, keys: Sequence[str], fields: Sequence[str], separator: str = "|") -> DataFrame:
    """Wide ``field|ticker`` columns to rows of keys, ticker and fields; rows without any value go."""
    tickers = sorted({c.split(separator, 1)[1] for c in df.columns if separator in c})
    null = F.lit(None).cast("double")
    cells = [F.struct(F.lit(t).alias("ticker"), *[(F.col(f"`{f}{separator}{t}`").cast("double") if f"{f}{separator}{t}" in df.columns else null).alias(f) for f in fields]) for t in tickers]
    return df.select(*keys, F.explode(F.array(*cells)).alias("c")).select(*keys, "c.*").filter(F.coalesce(*fields).isNotNull())


def filing_rows(docs: DataFrame, key: str, arrays: Sequence[str], forms: Sequence[str], most: int) -> DataFrame:
    """Parallel arrays to rows: the ``most`` latest filings of the given forms of each key."""
    from ledgerspark.operators.dedup import top_n

    rows = docs.select(key, F.explode(F.arrays_zip(*arrays)).alias("f")).select(key, "f.*").filter(F.col("form").isin(*forms))
    return top_n(rows, [key], [F.desc("filing_date"), F.asc("form")], most)


def json_pairs(df: DataFrame, column: str) -> DataFrame:
    """``key, value`` of each entry of a flat JSON object; broken JSON gives none."""
    return df.select(F.explode(F.from_json(column, "map<string,string>")).alias("key", "value"))


def incremental_scope(universe: DataFrame, have: DataFrame, keys: Sequence[str], date: str, today: Column, fresh_days: int, buffer_days: int = 7) -> DataFrame:
    """``keys, last, state, fetch_from``: new keys need all, stale ones from their last date less a buffer, fresh none."""
    last = have.groupBy(*keys).agg(F.max(date).alias("last"))
    j = universe.join(last, list(keys), "left")
    state = F.when(F.col("last").isNull(), "new").when(F.datediff(today, F.col("last")) <= fresh_days, "fresh").otherwise("stale")
    return j.withColumn("state", state).withColumn("fetch_from", F.when(F.col("state") == "stale", F.date_sub("last", buffer_days)))


def read_banner_csv(spark: SparkSession, path: str, first_column: str) -> DataFrame:
    """A CSV with banner lines before its header and footer lines after: rows as wide as the header, by name."""
    lines = spark.read.text(path, wholetext=False)
    header = lines.filter(F.col("value").startswith(first_column)).limit(1).first()
    if header is None:
        raise ValueError(f"no header that starts with {first_column}")
    names = [n.strip().strip('"') for n in header["value"].split(",")]
    fields = F.from_csv("value", ", ".join(f"`{n}` string" for n in names))
    wide = lines.filter((F.col("value") != header["value"]) & (F.size(F.split("value", ",")) >= len(names)))
    return wide.select(fields.alias("r")).select("r.*").filter(F.col(f"`{names[-1]}`").isNotNull())


def read_jsonc(text: str) -> dict:
    """Configuration JSON with // lines; keys that begin with an underscore are dropped."""
    plain = "\n".join(x for x in text.splitlines() if not x.lstrip().startswith("//"))

    def strip(node):
        if isinstance(node, dict):
            return {k: strip(v) for k, v in node.items() if not k.startswith("_")}
        return [strip(x) for x in node] if isinstance(node, list) else node

    return strip(json.loads(plain))


def flatten_tree(tree: dict) -> list[dict]:
    """Rows of a nested hierarchy {statement: {group: {... [leaves]}}}: section, group, parent, level, sort order per statement."""
    rows: list[dict] = []

    def walk(statement: str, node, path: list[str]) -> None:
        if isinstance(node, dict):
            for name, child in node.items():
                walk(statement, child, [*path, name])
            return
        for leaf in node:
            order = sum(r["statement"] == statement for r in rows) + 1
            rows.append({"statement": statement, "concept": leaf, "section": path[0] if path else None, "group": path[-1] if len(path) >= 2 else None, "parent": path[-1] if path else None, "level": len(path) + 1, "sort_order": order})

    for statement, node in tree.items():
        walk(statement, node, [])
    return rows
