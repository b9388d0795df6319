"""Entities -> RDF triples.

Each exporter scans its entity table once: it builds an array of conditional
triple structs per row (``NULL`` for absent conditions), drops the NULLs and
inlines the rest.  Triples are ``(s, p, o, o_kind, o_datatype)`` with
``o_kind`` ``'iri'`` or ``'literal'``.  The graph is a set, so ``triple_set``
runs one distinct (map-side partial dedup first, then one shuffle).
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarweave.functions.text import present

# Namespace IRIs and the default position label.
LOCAL = "http://vivo.mydomain.edu/individual/"
FOAF = "http://xmlns.com/foaf/0.1/"
CORE = "http://vivoweb.org/ontology/core#"
ERO = "http://purl.obolibrary.org/obo/"
VCARD = "http://www.w3.org/2006/vcard/ns#"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDFS_LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
XSD_ANYURI = "http://www.w3.org/2001/XMLSchema#anyURI"
DEFAULT_POSITION = "Wissenschaftlicher Mitarbeiter"

# Prefix bindings written with the graph (LOCAL is not bound) (K7).
PREFIXES = {"foaf": FOAF, "core": CORE, "ero": ERO, "vcard": VCARD}

TRIPLE_COLS = ["s", "p", "o", "o_kind", "o_datatype"]


def entry_iri(id_col: Column, prefix: str = "", suffix: str = "", base: str = LOCAL) -> Column:
    """``LOCAL + prefix + %08d + suffix`` (R0); NULL when the id is unknown."""
    return F.when(id_col.isNotNull(),
                  F.concat(F.lit(base), F.format_string(f"{prefix}%08d{suffix}", id_col)))


# Exporters are generated as one SQL expression each: the same plan as the
# Column API, built with one call instead of hundreds of small ones.

def _q(text: str) -> str:
    """Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _col(name: str) -> str:
    return f"`{name}`"


def _iri_sql(id_col: str, prefix: str = "", suffix: str = "", base: str = LOCAL) -> str:
    c = _col(id_col)
    return f"CASE WHEN {c} IS NOT NULL THEN concat({_q(base)}, format_string({_q(prefix + '%08d' + suffix)}, {c})) END"


def _t(s: str, p: str, o: str, kind: str, datatype: str | None = None) -> str:
    dt = "CAST(NULL AS STRING)" if datatype is None else _q(datatype)
    return f"named_struct('s', {s}, 'p', {_q(p)}, 'o', CAST({o} AS STRING), 'o_kind', {_q(kind)}, 'o_datatype', {dt})"


def _iri(s: str, p: str, o: str) -> str:
    return _t(s, p, o, "iri")


def _lit(s: str, p: str, o: str, datatype: str | None = None) -> str:
    return _t(s, p, o, "literal", datatype)


def _a(s: str, cls: str) -> str:
    return _iri(s, RDF_TYPE, _q(cls))


def _when(cond: str, t: str) -> str:
    return f"CASE WHEN {cond} THEN {t} END"


def _present(name: str) -> str:
    c = _col(name)
    return f"({c} IS NOT NULL AND {c} <> '')"


def _array_sql(triples: list[str]) -> str:
    return f"filter(array({', '.join(triples)}), t -> t IS NOT NULL AND t.o IS NOT NULL AND t.s IS NOT NULL)"


def _emit(df: DataFrame, triples: list[str]) -> DataFrame:
    return df.selectExpr(f"inline({_array_sql(triples)})").select(*TRIPLE_COLS)


def _person_list(base: str) -> list[str]:
    """Person exporter without roles.

    Expects ``id, name, firstname, lastname, email, title, phone, position
    (array<string>), organization_id``.  A name is structured when firstname
    and lastname are set (``set_name`` stores both).
    """
    p, i = _iri_sql("id", "p", "", base), _iri_sql("id", "i", "", base)
    i8, i1 = _iri_sql("id", "i", "8", base), _iri_sql("id", "i", "1", base)
    i2, i4 = _iri_sql("id", "i", "2", base), _iri_sql("id", "i", "4", base)
    m = _iri_sql("id", "m", "", base)
    org = _iri_sql("organization_id", "o", "", base)
    structured = "(`firstname` IS NOT NULL AND `lastname` IS NOT NULL)"
    label = f"CASE WHEN {structured} THEN concat(`lastname`, ', ', `firstname`) ELSE `name` END"
    has_email, has_title, has_phone = _present("email"), _present("title"), _present("phone")
    pos_text = "array_join(`position`, ', ')"
    pos_label = f"CASE WHEN {pos_text} IS NOT NULL AND {pos_text} <> '' THEN {pos_text} ELSE {_q(DEFAULT_POSITION)} END"
    return [
        _a(p, FOAF + "NonFacultyAcademic"),
        _when(structured, _a(i8, VCARD + "Name")),
        _when(structured, _lit(i8, VCARD + "familyName", "`lastname`")),
        _when(structured, _lit(i8, VCARD + "givenName", "`firstname`")),
        _lit(p, RDFS_LABEL, label),
        _when(has_email, _a(i1, VCARD + "Work")),
        _when(has_email, _a(i1, VCARD + "Email")),
        _when(has_email, _lit(i1, VCARD + "email", "`email`")),
        _when(has_title, _a(i2, VCARD + "Title")),
        _when(has_title, _lit(i2, VCARD + "title", "`title`")),
        _when(has_phone, _a(i4, VCARD + "Telephone")),
        _when(has_phone, _lit(i4, VCARD + "telephone", "`phone`")),
        _a(i, VCARD + "Individual"),
        _iri(i, ERO + "ARG_2000029", p),
        _when(structured, _iri(i, VCARD + "hasName", i8)),
        _when(has_email, _iri(i, VCARD + "hasEmail", i1)),
        _when(has_phone, _iri(i, VCARD + "hasTelephone", i4)),
        _when(has_title, _iri(i, VCARD + "hasTitle", i2)),
        _a(m, CORE + "NonFacultyAcademicPosition"),
        _lit(m, RDFS_LABEL, pos_label),
        _iri(m, CORE + "relates", p),
        _iri(m, CORE + "relates", org),
    ]


def _role_list(base: str) -> list[str]:
    """Division membership of a person (R7); one set per resolved role row.

    Expects ``role_id, division_id, person_id, name`` (from ``resolve_roles``).
    """
    dm = _iri_sql("role_id", "dm", "", base)
    od = _iri_sql("division_id", "od", "", base)
    p = _iri_sql("person_id", "p", "", base)
    return [
        _a(dm, CORE + "MemberRole"),
        _a(od, CORE + "Division"),
        _lit(dm, RDFS_LABEL, "`name`"),
        _iri(dm, ERO + "RO_0000052", p),
        _iri(dm, CORE + "roleContributesTo", od),
        _iri(p, ERO + "RO_0000053", dm),
        _iri(od, CORE + "contributingRole", dm),
    ]


# Address fields exported for an organisation: item field -> vCard property.
ORG_ADDRESS_FIELDS = [("street_address", "streetAddress"), ("country", "country"),
                      ("postal_code", "postalCode"), ("city", "city")]


def _organization_list(base: str) -> list[str]:
    """Organisation exporter."""
    o = _iri_sql("id", "o", "", base)
    oi, oi1, oi2 = _iri_sql("id", "oi", "", base), _iri_sql("id", "oi", "1", base), _iri_sql("id", "oi", "2", base)
    has_addr = "(" + " OR ".join(_present(f) for f, _ in ORG_ADDRESS_FIELDS) + ")"
    t = [
        _a(o, FOAF + "Organization"),
        _lit(o, RDFS_LABEL, "`name`"),
        _when(has_addr, _a(oi1, VCARD + "Address")),
    ]
    t += [_when(_present(f), _lit(oi1, VCARD + prop, _col(f))) for f, prop in ORG_ADDRESS_FIELDS]
    t += [
        _a(oi2, VCARD + "URL"),
        _lit(oi2, VCARD + "url", "`source_url`", XSD_ANYURI),
        _a(oi, VCARD + "Individual"),
        _a(oi, VCARD + "Kind"),
        _iri(oi, ERO + "ARG_2000029", o),
        _iri(oi, VCARD + "hasURL", oi2),
        _when(has_addr, _iri(oi, VCARD + "hasAddress", oi1)),
    ]
    return t


def _division_list(base: str) -> list[str]:
    """Division exporter."""
    od = _iri_sql("id", "od", "", base)
    return [
        _a(od, CORE + "Division"),
        _lit(od, RDFS_LABEL, "`name`"),
        _iri(od, ERO + "BFO_0000050", _iri_sql("organization_id", "o", "", base)),
    ]


_LISTS = {"Person": _person_list, "DivisionRole": _role_list, "Organization": _organization_list,
          "Division": _division_list}


def person_triples(persons: DataFrame, base: str = LOCAL) -> DataFrame:
    return _emit(persons, _person_list(base))


def role_triples(roles: DataFrame, base: str = LOCAL) -> DataFrame:
    return _emit(roles, _role_list(base))


def organization_triples(orgs: DataFrame, base: str = LOCAL) -> DataFrame:
    return _emit(orgs, _organization_list(base))


def division_triples(divisions: DataFrame, base: str = LOCAL) -> DataFrame:
    return _emit(divisions, _division_list(base))


def triple_set(*parts: DataFrame) -> DataFrame:
    """Union of the per-type triples as a set."""
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def _escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit('"'), F.lit('\\"'))
    c = F.replace(c, F.lit("\n"), F.lit("\\n"))
    c = F.replace(c, F.lit("\r"), F.lit("\\r"))
    return F.replace(c, F.lit("\t"), F.lit("\\t"))


def ntriple(s: Column, p: Column, o: Column, o_kind: Column, o_datatype: Column) -> Column:
    """The N-Triples line of a triple."""
    obj = (F.when(o_kind == "iri", F.concat(F.lit("<"), o, F.lit(">")))
           .when(o_datatype.isNotNull(), F.concat(F.lit('"'), _escape(o), F.lit('"^^<'), o_datatype, F.lit(">")))
           .otherwise(F.concat(F.lit('"'), _escape(o), F.lit('"'))))
    return F.concat(F.lit("<"), s, F.lit("> <"), p, F.lit("> "), obj, F.lit(" ."))


def ntriples_lines(triples: DataFrame) -> DataFrame:
    """One N-Triples line per triple (K5): safe to concatenate across files."""
    return triples.select(ntriple(*[F.col(c) for c in TRIPLE_COLS]).alias("line"))


def n3_lines(triples: DataFrame) -> DataFrame:
    """One N3 line per triple, with predicates, classes and datatypes as prefixed names where a binding fits (K5).

    Only IRIs whose rest after the prefix is letters, digits and ``_`` from a letter on are shortened; the
    lines need the bindings of ``PREFIXES`` before them.
    """
    def short(iri: Column) -> Column:
        out = F.concat(F.lit("<"), iri, F.lit(">"))
        for name, base in PREFIXES.items():
            rest = F.substr(iri, F.lit(len(base) + 1))
            out = F.when(iri.startswith(base) & rest.rlike("^[A-Za-z][A-Za-z0-9_]*$"),
                         F.concat(F.lit(f"{name}:"), rest)).otherwise(out)
        return out

    s, p, o, kind, datatype = (F.col(c) for c in TRIPLE_COLS)
    text = F.concat(F.lit('"'), _escape(o), F.lit('"'))
    obj = F.when(kind == "iri", short(o)).when(
        datatype.isNotNull(), F.concat(text, F.lit("^^"), short(datatype))).otherwise(text)
    return triples.select(F.concat(F.lit("<"), s, F.lit("> "), short(p), F.lit(" "), obj, F.lit(" .")).alias("line"))


def entity_lines(entities: str, base: str = LOCAL) -> Column:
    """Sorted N-Triples lines of each entity of an array (SQL), whatever its type; no line for types without an exporter.

    An entity is a struct of ``item_type`` and the columns of every exporter.
    """
    made = " ".join(f"WHEN {_col('item_type')} = {_q(t)} THEN {_array_sql(make(base))}" for t, make in _LISTS.items())
    of_entity = re.sub(r"`\w+`", lambda c: f"e.{c.group()}", f"CASE {made} END")
    line = lambda t: ntriple(*[t[c] for c in TRIPLE_COLS])
    return F.transform(F.expr(f"transform({entities}, e -> {of_entity})"), lambda triples: F.array_sort(F.array_distinct(
        F.coalesce(F.transform(triples, line), F.array().cast("array<string>")))))
