"""Graph queries on region / nation / customer / supplier (§7.2, §7.4).

The driver tables stand in for scraped entities: region -> Organization,
nation -> Division, customer/supplier -> Person, and one DivisionRole per
person.  The ``render_*`` functions only shape test input (URLs, names,
contact fields from real columns); all the work runs through the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.functions.names import FIRST_LAST, split_name
from scholarweave.operators import ids as idops
from scholarweave.operators import triples as tr
from scholarweave.plans.graph import build_graph
from scholarweave.plans.registry import query
from scholarweave.session import table
from scholarweave.sinks.registry import append_registry, read_registry
from scholarweave.streaming.incremental import scratch_dir

ORG_ROOT = "http://org.example.org/"
PEOPLE_ROOT = "http://people.example.org/"

# ----------------------------------------------------------------------------- renderers


def render_orgs(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "region")
    addr = F.col("r_name").startswith("A")
    return r.select(
        F.col("r_regionkey").alias("source"),
        F.concat(F.lit(ORG_ROOT), F.lower("r_name"), F.lit("/")).alias("source_url"),
        F.col("r_name").alias("name"),
        F.when(addr, F.concat("r_name", F.lit(" Strasse 1"))).otherwise(F.lit("")).alias("street_address"),
        F.when(addr, (F.col("r_regionkey") + 10000).cast("string")).alias("postal_code"),
        F.when(F.col("r_name").endswith("A"), F.lower("r_name")).otherwise(F.lit("")).alias("city"),
        F.lit(None).cast("string").alias("country"),
    )


def division_url(key_col) -> F.Column:
    return F.concat(F.lit(ORG_ROOT + "division/"), key_col.cast("string"))


def render_divisions(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    return n.select(F.col("n_regionkey").alias("source"),
                    division_url(F.col("n_nationkey")).alias("source_url"),
                    F.col("n_name").alias("name"))


def render_persons(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    display = F.replace(F.col("c_name"), F.lit("#"), F.lit(" "))
    nm = split_name(display, FIRST_LAST)
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("n_regionkey").alias("source"),
        F.concat(F.lit(PEOPLE_ROOT + "c/"), F.col("c_custkey").cast("string")).alias("source_url"),
        display.alias("name"),
        nm["firstname"].alias("firstname"),
        nm["lastname"].alias("lastname"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"),
               F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.org")))
         .otherwise(F.lit("")).alias("email"),
        F.when(F.col("c_acctbal") > 5000, F.lit("Dr.")).otherwise(F.lit("")).alias("title"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD",
               F.concat(F.lit("+49 30 "), F.col("c_custkey").cast("string"))).alias("phone"),
        F.when(F.col("c_acctbal") > 8000, F.array("c_mktsegment"))
         .otherwise(F.array().cast("array<string>")).alias("position"),
        F.col("c_nationkey"), F.col("c_acctbal"), F.col("c_custkey"),
    ))


def render_roles(persons: DataFrame) -> DataFrame:
    div = division_url(F.col("c_nationkey"))
    return persons.select(
        div.alias("source_url"), F.lit("Leiter").alias("name"),
        F.when(F.col("c_acctbal") >= 0, div).otherwise(F.lit("")).alias("division_url"),
        F.col("source_url").alias("person_url"))


# ----------------------------------------------------------------------------- oracle SQL

SQL_RENDER = f"""
orgs AS (
  SELECT r_regionkey AS source, '{ORG_ROOT}' || lower(r_name) || '/' AS source_url, r_name AS name,
         CASE WHEN r_name LIKE 'A%' THEN r_name || ' Strasse 1' ELSE '' END AS street_address,
         CASE WHEN r_name LIKE 'A%' THEN CAST(r_regionkey + 10000 AS VARCHAR) END AS postal_code,
         CASE WHEN r_name LIKE '%A' THEN lower(r_name) ELSE '' END AS city,
         CAST(NULL AS VARCHAR) AS country
  FROM region),
divs AS (
  SELECT n_regionkey AS source, '{ORG_ROOT}division/' || CAST(n_nationkey AS VARCHAR) AS source_url,
         n_name AS name FROM nation),
pers AS (
  SELECT n.n_regionkey AS source, '{PEOPLE_ROOT}c/' || CAST(c_custkey AS VARCHAR) AS source_url,
         replace(c_name, '#', ' ') AS name,
         split_part(replace(c_name, '#', ' '), ' ', 1) AS firstname,
         split_part(replace(c_name, '#', ' '), ' ', 2) AS lastname,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY')
              THEN lower(replace(c_name, '#', '.')) || '@example.org' ELSE '' END AS email,
         CASE WHEN c_acctbal > 5000 THEN 'Dr.' ELSE '' END AS title,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN '+49 30 ' || CAST(c_custkey AS VARCHAR) END AS phone,
         CASE WHEN c_acctbal > 8000 THEN c_mktsegment ELSE '' END AS position_text,
         c_nationkey, c_acctbal
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
roles AS (
  SELECT '{ORG_ROOT}division/' || CAST(c_nationkey AS VARCHAR) AS source_url, 'Leiter' AS name,
         CASE WHEN c_acctbal >= 0 THEN '{ORG_ROOT}division/' || CAST(c_nationkey AS VARCHAR) ELSE '' END
           AS division_url,
         source_url AS person_url
  FROM pers)"""

_ALL_KEYS = """
    SELECT source_url, 'Organization' AS item_type, 0 AS arrival FROM orgs
    UNION ALL SELECT source_url, 'Division', 0 FROM divs
    UNION ALL SELECT source_url, 'Person', 0 FROM pers
    UNION ALL SELECT source_url, 'DivisionRole', 0 FROM roles WHERE person_url <> '' AND division_url <> ''
    UNION ALL SELECT division_url, 'Division', 0 FROM roles WHERE person_url <> '' AND division_url <> ''"""


def sql_ids(all_keys: str = _ALL_KEYS) -> str:
    """IDs of the keys (source_url, item_type, arrival), those of an arrival in source_url order, and what joins to them."""
    return f"""
keys AS (
  SELECT source_url, item_type, min(arrival) AS arrival FROM ({all_keys})
  WHERE source_url IS NOT NULL AND source_url <> '' GROUP BY ALL),
ids AS (
  SELECT source_url, item_type,
         CAST(row_number() OVER (PARTITION BY item_type ORDER BY arrival, source_url) AS BIGINT) AS id
  FROM keys),
o AS (SELECT orgs.*, ids.id FROM orgs JOIN ids ON ids.item_type = 'Organization' AND ids.source_url = orgs.source_url),
d AS (SELECT divs.*, ids.id, o.id AS organization_id FROM divs
      JOIN ids ON ids.item_type = 'Division' AND ids.source_url = divs.source_url
      LEFT JOIN o ON o.source = divs.source),
p AS (SELECT pers.*, ids.id, o.id AS organization_id FROM pers
      JOIN ids ON ids.item_type = 'Person' AND ids.source_url = pers.source_url
      LEFT JOIN o ON o.source = pers.source),
r AS (SELECT ri.id AS role_id, di.id AS division_id, p.id AS person_id, roles.name,
             roles.source_url, roles.division_url, roles.person_url
      FROM roles JOIN p ON roles.person_url = p.source_url
      LEFT JOIN ids ri ON ri.item_type = 'DivisionRole' AND ri.source_url = roles.source_url
      LEFT JOIN ids di ON di.item_type = 'Division' AND di.source_url = roles.division_url
      WHERE roles.person_url <> '' AND roles.division_url <> '')"""


def _iri(prefix: str, idcol: str, suffix: str = "") -> str:
    return f"('{tr.LOCAL}' || printf('{prefix}%08d{suffix}', {idcol}))"


def _t(frm: str, s: str, p: str, o: str, kind: str = "iri", dt: str | None = None,
       where: str | None = None) -> str:
    dts = f"'{dt}'" if dt else "CAST(NULL AS VARCHAR)"
    w = f" WHERE {where}" if where else ""
    return (f"SELECT {s} AS s, '{p}' AS p, CAST({o} AS VARCHAR) AS o, '{kind}' AS o_kind, "
            f"{dts} AS o_datatype FROM {frm}{w}")


def _a(frm: str, s: str, cls: str, where: str | None = None) -> str:
    return _t(frm, s, tr.RDF_TYPE, f"'{cls}'", where=where)


def _present(c: str) -> str:
    return f"({c} IS NOT NULL AND {c} <> '')"


def _person_sql() -> list[str]:
    V, C, E, F_ = tr.VCARD, tr.CORE, tr.ERO, tr.FOAF
    p, i = _iri("p", "id"), _iri("i", "id")
    i8, i1, i2, i4 = _iri("i", "id", "8"), _iri("i", "id", "1"), _iri("i", "id", "2"), _iri("i", "id", "4")
    m, org = _iri("m", "id"), _iri("o", "organization_id")
    st = "(firstname IS NOT NULL AND lastname IS NOT NULL)"
    em, ti, ph = _present("email"), _present("title"), _present("phone")
    label = "CASE WHEN firstname IS NOT NULL AND lastname IS NOT NULL THEN lastname || ', ' || firstname ELSE name END"
    pos = f"CASE WHEN {_present('position_text')} THEN position_text ELSE '{tr.DEFAULT_POSITION}' END"
    return [
        _a("p", p, F_ + "NonFacultyAcademic"),
        _a("p", i8, V + "Name", st),
        _t("p", i8, V + "familyName", "lastname", "literal", where=st),
        _t("p", i8, V + "givenName", "firstname", "literal", where=st),
        _t("p", p, tr.RDFS_LABEL, label, "literal"),
        _a("p", i1, V + "Work", em), _a("p", i1, V + "Email", em),
        _t("p", i1, V + "email", "email", "literal", where=em),
        _a("p", i2, V + "Title", ti), _t("p", i2, V + "title", "title", "literal", where=ti),
        _a("p", i4, V + "Telephone", ph), _t("p", i4, V + "telephone", "phone", "literal", where=ph),
        _a("p", i, V + "Individual"), _t("p", i, E + "ARG_2000029", p),
        _t("p", i, V + "hasName", i8, where=st), _t("p", i, V + "hasEmail", i1, where=em),
        _t("p", i, V + "hasTelephone", i4, where=ph), _t("p", i, V + "hasTitle", i2, where=ti),
        _a("p", m, C + "NonFacultyAcademicPosition"),
        _t("p", m, tr.RDFS_LABEL, pos, "literal"),
        _t("p", m, C + "relates", p),
        _t("p", m, C + "relates", org, where="organization_id IS NOT NULL"),
    ]


def _role_sql() -> list[str]:
    C, E = tr.CORE, tr.ERO
    dm, od, p = _iri("dm", "role_id"), _iri("od", "division_id"), _iri("p", "person_id")
    return [
        _a("r", dm, C + "MemberRole"), _a("r", od, C + "Division"),
        _t("r", dm, tr.RDFS_LABEL, "name", "literal"),
        _t("r", dm, E + "RO_0000052", p), _t("r", dm, C + "roleContributesTo", od),
        _t("r", p, E + "RO_0000053", dm), _t("r", od, C + "contributingRole", dm),
    ]


def _org_sql() -> list[str]:
    V, E, F_ = tr.VCARD, tr.ERO, tr.FOAF
    o, oi, oi1, oi2 = _iri("o", "id"), _iri("oi", "id"), _iri("oi", "id", "1"), _iri("oi", "id", "2")
    has_addr = "(" + " OR ".join(_present(f) for f, _ in tr.ORG_ADDRESS_FIELDS) + ")"
    out = [_a("o", o, F_ + "Organization"), _t("o", o, tr.RDFS_LABEL, "name", "literal"),
           _a("o", oi1, V + "Address", has_addr)]
    out += [_t("o", oi1, V + prop, f, "literal", where=_present(f)) for f, prop in tr.ORG_ADDRESS_FIELDS]
    out += [_a("o", oi2, V + "URL"), _t("o", oi2, V + "url", "source_url", "literal", tr.XSD_ANYURI),
            _a("o", oi, V + "Individual"), _a("o", oi, V + "Kind"),
            _t("o", oi, E + "ARG_2000029", o), _t("o", oi, V + "hasURL", oi2),
            _t("o", oi, V + "hasAddress", oi1, where=has_addr)]
    return out


def _division_sql() -> list[str]:
    od = _iri("od", "id")
    return [_a("d", od, tr.CORE + "Division"), _t("d", od, tr.RDFS_LABEL, "name", "literal"),
            _t("d", od, tr.ERO + "BFO_0000050", _iri("o", "organization_id"),
               where="organization_id IS NOT NULL")]


def triples_sql(render: str, ids: str) -> str:
    return ("WITH " + render + "," + ids + "\n" +
            "\nUNION\n".join(_person_sql() + _role_sql() + _org_sql() + _division_sql()))


RDF_TRIPLES_SQL = triples_sql(SQL_RENDER, sql_ids())


def _graph(spark: SparkSession, sf: str):
    persons = render_persons(spark, sf)
    return build_graph(render_orgs(spark, sf), render_divisions(spark, sf), persons, render_roles(persons))


@query("rdf_triples", RDF_TRIPLES_SQL)
def rdf_triples(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: IDs (W2), organisation (J8), roles (J7), triples (R1-R11), set (A4)."""
    return _graph(spark, sf).triples


@query("rdf_entry_iri", f"""
SELECT c_custkey, {_iri('p', 'c_custkey')} AS person_iri, {_iri('i', 'c_custkey', '8')} AS name_iri,
       {_iri('dm', 'c_custkey')} AS role_iri
FROM customer""")
def rdf_entry_iri(spark: SparkSession, sf: str) -> DataFrame:
    """``LOCAL + prefix + %08d + suffix`` on every customer key."""
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select("c_custkey", tr.entry_iri(k, "p").alias("person_iri"),
                    tr.entry_iri(k, "i", "8").alias("name_iri"), tr.entry_iri(k, "dm").alias("role_iri"))


def _nt_obj_sql() -> str:
    esc = "replace(replace(replace(replace(replace(o, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
    return (f"CASE WHEN o_kind = 'iri' THEN '<' || o || '>' "
            f"WHEN o_datatype IS NOT NULL THEN '\"' || {esc} || '\"^^<' || o_datatype || '>' "
            f"ELSE '\"' || {esc} || '\"' END")


LINES_OF_T = f"SELECT '<' || s || '> <' || p || '> ' || {_nt_obj_sql()} || ' .' AS line FROM t"
_LINES_SQL = f"WITH t AS ({RDF_TRIPLES_SQL})\n{LINES_OF_T}"


@query("rdf_ntriples_lines", _LINES_SQL)
def rdf_ntriples_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The whole graph, persons and roles included, as N-Triples lines (K5)."""
    return tr.ntriples_lines(_graph(spark, sf).triples)


def _customer_keys(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(F.concat(F.lit(PEOPLE_ROOT + "c/"), F.col("c_custkey").cast("string")).alias("source_url"),
                    F.col("c_mktsegment").alias("item_type"), "c_acctbal")


@query("entity_ids", f"""
SELECT source_url, item_type,
       CAST(row_number() OVER (PARTITION BY item_type ORDER BY source_url) AS BIGINT) AS id
FROM (SELECT DISTINCT '{PEOPLE_ROOT}c/' || CAST(c_custkey AS VARCHAR) AS source_url,
             c_mktsegment AS item_type FROM customer)""")
def entity_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Dense IDs per item type in source_url order, no one-task window."""
    ids, _ = idops.assign_ids(_customer_keys(spark, sf))
    return ids


@query("entity_ids_incremental", f"""
WITH k AS (SELECT DISTINCT '{PEOPLE_ROOT}c/' || CAST(c_custkey AS VARCHAR) AS source_url,
                  c_mktsegment AS item_type, c_acctbal < 5000 AS first_run FROM customer),
reg AS (SELECT source_url, item_type,
               row_number() OVER (PARTITION BY item_type ORDER BY source_url) AS id FROM k WHERE first_run),
mx AS (SELECT item_type, max(id) AS base_id FROM reg GROUP BY item_type),
new AS (SELECT k.source_url, k.item_type,
               coalesce(mx.base_id, 0) + row_number() OVER (PARTITION BY k.item_type ORDER BY k.source_url) AS id
        FROM k LEFT JOIN mx USING (item_type) WHERE NOT k.first_run)
SELECT source_url, item_type, CAST(id AS BIGINT) AS id FROM reg
UNION ALL SELECT source_url, item_type, CAST(id AS BIGINT) AS id FROM new""")
def entity_ids_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Second run against the bucketed registry of a first run: old IDs kept, new ones after max."""
    keys = _customer_keys(spark, sf)
    path = f"{scratch_dir(spark, 'ids')}/registry"
    _, first_rows = idops.assign_ids(keys.where(F.col("c_acctbal") < 5000))
    append_registry(first_rows, path)
    ids, _ = idops.assign_ids(keys, registry=read_registry(spark, path))
    return ids


@query("organization_assignment", f"""
WITH o AS (SELECT r_regionkey AS source,
                  CAST(row_number() OVER (ORDER BY '{ORG_ROOT}' || lower(r_name) || '/') AS BIGINT) AS id
           FROM region)
SELECT c.c_custkey, o.id AS organization_id
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN o ON o.source = n.n_regionkey""")
def organization_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """Every person gets its source's organisation id, arrival order irrelevant."""
    orgs = render_orgs(spark, sf)
    ids, _ = idops.assign_ids(orgs.select("source_url", F.lit("Organization").alias("item_type")))
    orgs_i = idops.attach_id(orgs, ids, "Organization")
    persons = render_persons(spark, sf)
    return idops.assign_organization(persons, orgs_i).select("c_custkey", "organization_id")


@query("division_roles", f"""
WITH pers AS (SELECT '{PEOPLE_ROOT}s/' || CAST(s_suppkey AS VARCHAR) AS source_url, s_nationkey, s_acctbal FROM supplier),
roles AS (SELECT '{ORG_ROOT}division/' || CAST(s_nationkey AS VARCHAR) AS source_url, 'Leiter' AS name,
                 CASE WHEN s_acctbal >= 0 THEN '{ORG_ROOT}division/' || CAST(s_nationkey AS VARCHAR) ELSE '' END AS division_url,
                 CASE WHEN s_acctbal > 9000 THEN '' ELSE source_url END AS person_url FROM pers),
v AS (SELECT * FROM roles WHERE person_url <> '' AND division_url <> ''),
keys AS (SELECT DISTINCT source_url, item_type FROM (
   SELECT source_url, 'Person' AS item_type FROM pers
   UNION ALL SELECT '{ORG_ROOT}division/' || CAST(n_nationkey AS VARCHAR), 'Division' FROM nation
   UNION ALL SELECT source_url, 'DivisionRole' FROM v UNION ALL SELECT division_url, 'Division' FROM v)),
ids AS (SELECT source_url, item_type, CAST(row_number() OVER (PARTITION BY item_type ORDER BY source_url) AS BIGINT) AS id FROM keys)
SELECT ri.id AS role_id, v.name, v.source_url, v.division_url, v.person_url, di.id AS division_id, pi.id AS person_id
FROM v JOIN ids pi ON pi.item_type = 'Person' AND pi.source_url = v.person_url
LEFT JOIN ids ri ON ri.item_type = 'DivisionRole' AND ri.source_url = v.source_url
LEFT JOIN ids di ON di.item_type = 'Division' AND di.source_url = v.division_url""")
def division_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Role -> role/person/division IDs; blank person or division URL drops the role."""
    s = table(spark, sf, "supplier")
    persons = s.select(F.concat(F.lit(PEOPLE_ROOT + "s/"), F.col("s_suppkey").cast("string")).alias("source_url"),
                       "s_nationkey", "s_acctbal")
    div = division_url(F.col("s_nationkey"))
    roles = persons.select(
        div.alias("source_url"), F.lit("Leiter").alias("name"),
        F.when(F.col("s_acctbal") >= 0, div).otherwise(F.lit("")).alias("division_url"),
        F.when(F.col("s_acctbal") > 9000, F.lit("")).otherwise(F.col("source_url")).alias("person_url"))
    valid = roles.where((F.col("person_url") != "") & (F.col("division_url") != ""))
    divisions = render_divisions(spark, sf)
    keys = idops.needed_keys(
        persons.select("source_url", F.lit("Person").alias("item_type")),
        divisions.select("source_url", F.lit("Division").alias("item_type")),
        valid.select("source_url", F.lit("DivisionRole").alias("item_type")),
        valid.select(F.col("division_url").alias("source_url"), F.lit("Division").alias("item_type")))
    ids, _ = idops.assign_ids(keys)
    persons_i = idops.attach_id(persons, ids, "Person")
    return idops.resolve_roles(roles, persons_i, ids)
