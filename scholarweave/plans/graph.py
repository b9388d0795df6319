"""Item -> ID -> organisation -> RDF, as one DataFrame plan (X1 batch DAG, §3.2).

Inputs are per-type entity frames.  Persons and divisions carry a ``source``
column naming the organisation they belong to; organisations carry the same
``source`` key.  Roles are DivisionRole rows ``(source_url, name,
division_url, person_url)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarweave.functions.text import present
from scholarweave.operators import ids as idops
from scholarweave.operators import triples as tr
from scholarweave.schemas import conform


ROWS_PER_TASK = 20_000      # entities whose triples one task makes


@dataclass
class Graph:
    triples: DataFrame
    ids: DataFrame
    new_registry_rows: DataFrame
    persons: DataFrame
    divisions: DataFrame
    organizations: DataFrame
    roles: DataFrame
    dropped: DataFrame       # F3: items without a source_url, counted per type and reason


def _dropped(frames: dict[str, DataFrame]) -> DataFrame:
    """Count items dropped for a NULL or an empty ``source_url`` (lazy; one aggregate)."""
    parts = [df.where(~present("source_url")).select(
                F.lit(t).alias("item_type"),
                F.when(F.col("source_url").isNull(), F.lit("null")).otherwise(F.lit("blank")).alias("reason"))
             for t, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("item_type", "reason").agg(F.count(F.lit(1)).alias("n"))


def _typed_keys(df: DataFrame, item_type: str, url_col: str = "source_url") -> DataFrame:
    return df.select(F.col(url_col).alias("source_url"), F.lit(item_type).alias("item_type"))


def build_graph(orgs: DataFrame, divisions: DataFrame, persons: DataFrame, roles: DataFrame,
                registry: DataFrame | None = None, base: str = tr.LOCAL,
                partitions: int | None = None, publications: DataFrame | None = None) -> Graph:
    # an item without a source_url gets no ID and is not exported.
    # IDs and organisation ids are assigned here, whatever the input carries.
    orgs, divisions, persons = (conform(orgs, "Organization"), conform(divisions, "Division"),
                                conform(persons, "Person"))
    dropped = _dropped({"Organization": orgs, "Division": divisions, "Person": persons})
    orgs = orgs.drop("id").where(present("source_url"))
    divisions = divisions.drop("id", "organization_id").where(present("source_url"))
    persons = persons.drop("id", "organization_id").where(present("source_url"))
    valid_roles = roles.where(present("person_url") & present("division_url"))

    published = [] if publications is None else [_typed_keys(publications.where(present("source_url")), "Publication")]
    keys = idops.needed_keys(                                   # U3
        _typed_keys(orgs, "Organization"),
        _typed_keys(divisions, "Division"),
        _typed_keys(persons, "Person"),
        _typed_keys(valid_roles, "DivisionRole"),
        _typed_keys(valid_roles, "Division", "division_url"),
        *published,
    )
    ids, new_rows = idops.assign_ids(keys, registry, partitions)  # S4, U4, W2

    orgs_i = idops.attach_id(orgs, ids, "Organization")
    divs_i = idops.assign_organization(idops.attach_id(divisions, ids, "Division"), orgs_i)  # J8
    pers_i = idops.assign_organization(idops.attach_id(persons, ids, "Person"), orgs_i)
    roles_i = idops.resolve_roles(valid_roles, pers_i, ids)     # J7

    # A row is a score of triples and the set keeps a task's in memory: rows are dealt by their number, for
    # adaptive execution would join partitions by the bytes that the rows have before.
    tasks = -(-ids.count() // ROWS_PER_TASK)
    dealt = lambda df: df.repartition(tasks) if tasks > 1 else df
    triples = tr.triple_set(                                    # U2, A4
        tr.person_triples(dealt(pers_i), base),
        tr.role_triples(dealt(roles_i), base),
        tr.organization_triples(orgs_i, base),
        tr.division_triples(divs_i, base),
    )
    return Graph(triples, ids, new_rows, pers_i, divs_i, orgs_i, roles_i, dropped)
