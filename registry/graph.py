"""Co-author graph, rankings, projections, components and graph files on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from colophon.operators import coauthor, components as comp, edge_store, forest, paths
from colophon.operators import projections as proj, stats
from colophon.session import Scratch
from colophon.sources import graphfiles
from registry.common import (
    AUTHOR, EDITOR, PART_AUTHOR, PART_PERSON, PERSON, author, editor, load, part_author,
    entries,
    part_person, person, publication,
)

ENTRIES, entry = entries()


_WEIGHT = "w as (select publication_key, 1.0 / count(*) as w from author group by 1)"
_GRAPH = _WEIGHT + """, graph as (
  select x.person_id as author1_id, y.person_id as author2_id, count(*) as pair_count,
         sum(w) as pair_weight
  from author x join author y on x.publication_key = y.publication_key
    and x.person_id < y.person_id join w on w.publication_key = x.publication_key
  group by 1, 2)"""
_DEGREE = """degree as (
  select author_id, cast(sum(pair_count) as bigint) as author_count,
         sum(pair_weight) as author_weight
  from (select author1_id as author_id, pair_count, pair_weight from graph
        union all select author2_id, pair_count, pair_weight from graph) group by 1)"""


def _rounded(df, column, digits=6):
    return df.withColumn(column, F.round(column, digits))


@entry("coauthor_pairs", f"""
with {PART_AUTHOR}, {_WEIGHT}
select x.person_id as author1_id, y.person_id as author2_id, x.publication_key,
  round(w, 6) as publ_weight
from author x join author y on x.publication_key = y.publication_key
  and x.person_id < y.person_id join w on w.publication_key = x.publication_key""")
def _(spark, sf):
    return _rounded(coauthor.coauthor_pairs(part_author(spark, sf)), "publ_weight")


@entry("coauthor_graph", f"""
with {PART_AUTHOR}, {_GRAPH}
select author1_id, author2_id, pair_count, round(pair_weight, 6) as pair_weight from graph""")
def _(spark, sf):
    return _rounded(coauthor.coauthor_graph(part_author(spark, sf)), "pair_weight")


@entry("coauthor_graph_dense", f"""
with {AUTHOR}, {_GRAPH}
select author1_id, author2_id, pair_count, round(pair_weight, 6) as pair_weight from graph""")
def _(spark, sf):
    return _rounded(coauthor.coauthor_graph(author(spark, sf)), "pair_weight")


@entry("weighted_degree", f"""
with {PART_AUTHOR}, {_GRAPH}, {_DEGREE}
select author_id, author_count, round(author_weight, 6) as author_weight from degree""")
def _(spark, sf):
    graph = coauthor.coauthor_graph(part_author(spark, sf))
    return _rounded(coauthor.weighted_degree(graph), "author_weight")


@entry("top_authors", f"""
with {PERSON}, {AUTHOR}, {_GRAPH}, {_DEGREE}
select full_name, author_count, round(author_weight, 6) as author_weight
from degree left join person on id = author_id""")
def _(spark, sf):
    degrees = coauthor.weighted_degree_of_authors(author(spark, sf))
    return _rounded(coauthor.top_authors(degrees, person(spark, sf)), "author_weight")


@entry("top_10_authors", f"""
with {PART_PERSON}, {PART_AUTHOR}, {_GRAPH}, {_DEGREE}
select full_name, author_count, round(author_weight, 6) as author_weight
from (select * from degree
      order by round(author_weight, 9) desc nulls first, author_count desc nulls first, author_id
      limit 10) left join person on id = author_id""")
def _(spark, sf):
    degrees = coauthor.weighted_degree_of_authors(part_author(spark, sf))
    return _rounded(coauthor.top_authors(degrees, part_person(spark, sf), 10), "author_weight")


@entry("ranking_name_join", f"""
with {PART_PERSON}, {PART_AUTHOR}, {_GRAPH}, {_DEGREE}, ranking as (
  select full_name, author_count, round(author_weight, 6) as author_weight
  from degree left join person on id = author_id)
select r.full_name, r.author_count, r.author_weight, p.id as person_id
from ranking r left join person p on p.full_name = r.full_name
order by author_count asc nulls last, author_weight asc nulls last, r.full_name, p.id limit 10""")
def _(spark, sf):
    people = part_person(spark, sf)
    degrees = coauthor.weighted_degree_of_authors(part_author(spark, sf))
    ranking = _rounded(coauthor.top_authors(degrees, people), "author_weight")
    return coauthor.ranking_name_join(ranking, people)


@entry("top_pairs", f"""
with {PART_PERSON}, {PART_AUTHOR}, {_GRAPH}
select author1_id, author2_id, a.full_name as name1, b.full_name as name2,
  round(coauthor_weight, 6) as coauthor_weight
from (select author1_id, author2_id, round(pair_weight, 9) as coauthor_weight from graph
      order by coauthor_weight desc nulls first, author1_id, author2_id limit 80)
  join person a on a.id = author1_id join person b on b.id = author2_id""")
def _(spark, sf):
    graph = coauthor.coauthor_graph(part_author(spark, sf))
    return _rounded(coauthor.top_pairs(graph, part_person(spark, sf), 80), "coauthor_weight")


@entry("edge_other_end", f"""
with {PART_AUTHOR}, {_GRAPH}
select case author1_id when 7 then author2_id else author1_id end as other_id, pair_count,
  round(pair_weight, 6) as pair_weight from graph where author1_id = 7 or author2_id = 7""")
def _(spark, sf):
    graph = coauthor.coauthor_graph(part_author(spark, sf))
    return _rounded(coauthor.edge_other_end(graph, 7), "pair_weight")


_MERGED = f"""
with {PART_AUTHOR}, {_GRAPH}, early as (
  select author1_id, author2_id, pair_count, round(pair_weight, 9) as pair_weight
  from graph where pair_count > 1),
fresh as (
  select author1_id, author2_id, case when round(pair_weight, 9) > 0.5 then pair_count + 1
         else pair_count end as pair_count, round(pair_weight, 9) as pair_weight from graph),
merged as (select * from early union all
select * from fresh where not exists (
  select 1 from early where early.author1_id = fresh.author1_id
    and early.author2_id = fresh.author2_id and early.pair_count = fresh.pair_count
    and early.pair_weight = fresh.pair_weight))
select author1_id, author2_id, pair_count, round(pair_weight, 6) as pair_weight from merged"""


def _early_and_fresh(spark, sf):
    graph = coauthor.coauthor_graph(part_author(spark, sf))
    fresh = graph.withColumn("pair_count", F.when(
        coauthor.above(0.5), F.col("pair_count") + 1).otherwise(F.col("pair_count")))
    return graph.where("pair_count > 1"), fresh


@entry("merge_edges", _MERGED)
def _(spark, sf):
    early, fresh = _early_and_fresh(spark, sf)
    return _rounded(coauthor.merge_edges(early, fresh), "pair_weight")


@entry("merge_edge_store", _MERGED)
def _(spark, sf):
    early, fresh = _early_and_fresh(spark, sf)
    store = Scratch(spark, "store").path + "/edges"
    edge_store.write_store(early, store, 16)
    edge_store.merge_into(store, fresh, 16)
    return _rounded(edge_store.read_store(spark, store).drop("bucket"), "pair_weight")


_PATHS = f"""
with {PART_AUTHOR}, {_GRAPH}, e as (
  select author1_id as s, author2_id as d from graph
  union all select author2_id, author1_id from graph)
select a.d as id, 1 as depth, '1-' || a.d as path from e a where a.s = 1
union all
select b.d, 2, '1-' || a.d || '-' || b.d from e a join e b on b.s = a.d
where a.s = 1 and b.d <> 1
union all
select c.d, 3, '1-' || a.d || '-' || b.d || '-' || c.d
from e a join e b on b.s = a.d join e c on c.s = b.d
where a.s = 1 and b.d <> 1 and c.d <> 1 and c.d <> a.d"""


def _written_graph(spark, sf):
    return Scratch(spark, "graph").table(coauthor.coauthor_graph(part_author(spark, sf)), "edges")


def _dashed(found):
    return found.withColumn("path", F.concat_ws("-", F.transform("path", lambda v: v.cast("string"))))


@entry("khop_paths", _PATHS)
def _(spark, sf):
    return _dashed(paths.khop_paths(_written_graph(spark, sf), 1, 3))


@entry("khop_reach", f"select id, min(depth) as depth from ({_PATHS}) group by id")
def _(spark, sf):
    return paths.reach(paths.walk_layers(_written_graph(spark, sf), 1, 3), 1)


@entry("khop_paths_to", f"select * from ({_PATHS}) where id in (2, 3, 5, 8)")
def _(spark, sf):
    layers = paths.walk_layers(_written_graph(spark, sf), 1, 3)
    ends = spark.createDataFrame([(2,), (3,), (5,), (8,)], "id long")
    return _dashed(paths.paths_to(layers, ends, 1, 3))


# --- projections -----------------------------------------------------------------------------
@entry("project_bipartite", f"""
with {PART_AUTHOR}
select 'p:' || person_id as id from author union select 'k:' || publication_key from author""")
def _(spark, sf):
    return proj.minimal_vertices(comp.tagged_edges(part_author(spark, sf)))


@entry("project_weighted", f"""
with {PART_AUTHOR}, {_WEIGHT}
select person_id, publication_key, round(w, 6) as weight from author join w using
  (publication_key)""")
def _(spark, sf):
    return _rounded(proj.weighted_relation(part_author(spark, sf)), "weight")


@entry("projection_sizes", f"""
with {PART_AUTHOR}, {EDITOR}, n as (select count(*) as n from author)
select 'just_person' as name, (select count(*) from part) as nodes, 0 as relationships
union all select 'person_publication',
  (select count(*) from part) + (select count(*) from orders), n from n
union all select 'all', (select count(*) from part) + (select count(*) from orders)
  + (select count(*) from customer) + (select count(*) from supplier)
  + (select count(*) from nation) + (select count(*) from region), n from n
union all select 'minimal', (select count(distinct person_id) from author)
  + (select count(distinct publication_key) from author), n from n
union all select 'edited', (select count(distinct person_id) from editor)
  + (select count(distinct publication_key) from editor), (select count(*) from editor)""")
def _(spark, sf):
    edges = comp.tagged_edges(part_author(spark, sf))
    edited = comp.tagged_edges(editor(spark, sf))
    people, works = part_person(spark, sf), publication(spark, sf)
    both = comp.tagged_vertices(people, works)
    just_person = both.where(F.col("id").startswith("p:"))
    everything = both
    for table, key in (("customer", "c_custkey"), ("supplier", "s_suppkey"),
                       ("nation", "n_nationkey"), ("region", "r_regionkey")):
        everything = everything.unionAll(load(spark, sf, table).select(
            F.concat(F.lit(f"{table}:"), F.col(key).cast("string")).alias("id")))
    return proj.projection_sizes({
        "just_person": (just_person,
                        proj.relationships_within(edges, just_person, "src", "dst")),
        "person_publication": (both, proj.relationships_within(edges, both, "src", "dst")),
        "all": (everything, proj.relationships_within(edges, everything, "src", "dst")),
        "minimal": (proj.minimal_vertices(edges), edges),
        "edited": (proj.minimal_vertices(edited), edited),
    })


# --- components --------------------------------------------------------------------------------
def _labels_sql(edges: str, name: str) -> str:
    """Tables ``{name}(id, component)``: smallest reachable id, by keyed recursion over the
    mirrored edge table ``edges(s, d)``."""
    return f"""{name}(id, component) using key (id) as (
  select distinct s, s from {edges}
  union
  (select e.d, min(l.component)
   from {name} l join {edges} e on e.s = l.id join recurring.{name} now on now.id = e.d
   where l.component < now.component
   group by e.d))"""


_BIPARTITE = """e as materialized (
  select 'p:' || person_id as s, 'k:' || publication_key as d from {0}
  union all select 'k:' || publication_key, 'p:' || person_id from {0})"""
_THRESHOLDS = [0.4, 0.5, 0.6]


def _above_sql(threshold, n=""):
    return f"""e{n} as materialized (
  select author1_id as s, author2_id as d from graph where round(pair_weight, 9) > {threshold}
  union all select author2_id, author1_id from graph
            where round(pair_weight, 9) > {threshold})"""


@entry("component_of", f"""
with recursive {PART_AUTHOR}, {_GRAPH}, e as materialized (
  select author1_id as s, author2_id as d from graph
  union all select author2_id, author1_id from graph),
reach(id) as (select distinct s from e where s = 1
              union select e.d from reach join e on e.s = reach.id)
select id from reach""")
def _(spark, sf):
    graph = coauthor.coauthor_graph(part_author(spark, sf))
    return comp.component_of(Scratch(spark, "graph").table(graph, "edges"), 1)


@entry("components", f"""
with recursive {PART_AUTHOR}, {_BIPARTITE.format('author')}, {_labels_sql('e', 'label')},
persons as (select cast(substr(id, 3) as bigint) as person_id, component from label
            where id like 'p:%'),
smallest as (select component, min(person_id) as first from persons group by 1),
labelled as (select person_id, first from persons join smallest using (component))
select p_partkey as id, coalesce(first, p_partkey) as component
from part left join labelled on person_id = p_partkey""")
def _(spark, sf):
    labels = comp.author_components(part_author(spark, sf), include_isolated=False)
    return comp.with_isolated(labels, part_person(spark, sf), "id")


@entry("components_threshold", f"""
with recursive {PART_AUTHOR}, {_GRAPH}, {_above_sql(0.4, 0)}, {_above_sql(0.5, 1)},
{_above_sql(0.6, 2)}, {_labels_sql('e0', 'l0')}, {_labels_sql('e1', 'l1')},
{_labels_sql('e2', 'l2')}
""" + " union all ".join(
    f"select {t}::double as threshold, p_partkey as id, coalesce(component, p_partkey) as "
    f"component from part left join l{i} on l{i}.id = p_partkey"
    for i, t in enumerate(_THRESHOLDS)))
def _(spark, sf):
    edges = coauthor.edges_above(part_author(spark, sf), min(_THRESHOLDS))
    return comp.components_above(edges, _THRESHOLDS, part_person(spark, sf))


@entry("labels_after_merge", f"""
with recursive {PART_AUTHOR}, {_GRAPH}, {_above_sql(0.4)}, {_labels_sql('e', 'label')}
select id, component from label""")
def _(spark, sf):
    scratch = Scratch(spark, "merged")
    edges = scratch.table(coauthor.edges_above(part_author(spark, sf), 0.4), "edges")
    before = comp.connected_components(edges.where(coauthor.above(0.5)), "author1_id", "author2_id")
    return edge_store.merged_labels(scratch.table(before, "labels"), edges.where(~coauthor.above(0.5)))


_FIVE = [0.3, 0.4, 0.5, 0.6, 0.8]
_FIVE_SQL = ", ".join(_above_sql(t, i) + f", {_labels_sql(f'e{i}', f'l{i}')}" for i, t in enumerate(_FIVE))


def _forest(spark, sf):
    graph = Scratch(spark, "graph").table(coauthor.coauthor_graph(part_author(spark, sf)), "edges")
    return forest.spanning_forest(graph)


@entry("forest_edges_above", f"""
with recursive {PART_AUTHOR}, {_GRAPH}, {_FIVE_SQL}
""" + " union all ".join(
    f"select {t}::double as threshold, count(*) - count(distinct component) as n_edges from l{i}"
    for i, t in enumerate(_FIVE)))
def _(spark, sf):
    return forest.forest_edges_above(_forest(spark, sf), _FIVE)


@entry("components_of_forest", f"""
with recursive {PART_AUTHOR}, {_GRAPH}, {_FIVE_SQL}
""" + " union all ".join(
    f"select {t}::double as threshold, p_partkey as id, coalesce(component, p_partkey) as "
    f"component from part left join l{i} on l{i}.id = p_partkey"
    for i, t in enumerate(_FIVE)))
def _(spark, sf):
    return comp.components_above(_forest(spark, sf), _FIVE, part_person(spark, sf))


@entry("bipartite_components", f"""
with recursive {PART_AUTHOR}, {_BIPARTITE.format('author')}, {_labels_sql('e', 'label')}
select v.id, coalesce(component, v.id) as component
from (select 'p:' || p_partkey as id from part
      union all select 'k:' || o_orderkey from orders) v left join label on label.id = v.id""")
def _(spark, sf):
    return comp.bipartite_components(
        part_author(spark, sf),
        vertices=comp.tagged_vertices(part_person(spark, sf), publication(spark, sf)))


@entry("edited_components", f"""
with recursive {EDITOR}, {_BIPARTITE.format('editor')}, {_labels_sql('e', 'label')}
select v.id, coalesce(component, v.id) as component
from (select 'p:' || c_custkey as id from customer
      union all select 'k:' || o_orderkey from orders) v left join label on label.id = v.id""")
def _(spark, sf):
    people = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    return comp.bipartite_components(
        editor(spark, sf), vertices=comp.tagged_vertices(people, publication(spark, sf)))


def _half(spark, sf):
    """Labels of the parts at weight > 0.5, as a written table."""
    edges = coauthor.edges_above(part_author(spark, sf), 0.5)
    labels = comp.components_above(edges, [0.5], part_person(spark, sf)).drop("threshold")
    return Scratch(spark, "labels").table(labels, "labels")


_HALF = f"""with recursive {PART_AUTHOR}, {_GRAPH}, {_above_sql(0.5)},
{_labels_sql('e', 'label')}, half as (
  select p_partkey as id, coalesce(component, p_partkey) as component
  from part left join label on label.id = p_partkey)"""


_SIZES = "sizes as (select component, count(*) as size from half group by component)"
_DISTRIBUTION = "select count(*) as set_count, " + ", ".join(
    f"quantile_disc(size, {p / 100}) as p{p}" for p in stats.PERCENTILES) + " from sizes"


@entry("component_sizes_above", f"{_HALF}, {_SIZES} select * from sizes")
def _(spark, sf):
    return comp.component_sizes(_half(spark, sf))


@entry("component_distribution_above", f"{_HALF}, {_SIZES} {_DISTRIBUTION}")
def _(spark, sf):
    return stats.size_distribution(comp.component_sizes(_half(spark, sf)))


# The same over the whole graph, with persons who only wrote alone.
_WHOLE = f"""with recursive {PART_AUTHOR}, {_BIPARTITE.format('author')}, {_labels_sql('e', 'label')},
persons as (select cast(substr(id, 3) as bigint) as person_id, component from label
            where id like 'p:%'),
smallest as (select component, min(person_id) as first from persons group by 1),
half as (select p_partkey as id, p_name as full_name, coalesce(first, p_partkey) as component
         from part left join (persons join smallest using (component)) on person_id = p_partkey)"""


def _whole(spark, sf):
    labels = comp.author_components(part_author(spark, sf), include_isolated=False)
    return comp.with_isolated(labels, part_person(spark, sf), "id")


@entry("component_sizes", f"{_WHOLE}, {_SIZES} select * from sizes")
def _(spark, sf):
    return comp.component_sizes(_whole(spark, sf))


@entry("component_distribution", f"{_WHOLE}, {_SIZES} {_DISTRIBUTION}")
def _(spark, sf):
    return stats.size_distribution(comp.component_sizes(_whole(spark, sf)))


@entry("person_partition", f"""{_WHOLE}
select id, full_name, component as author_partition from half""")
def _(spark, sf):
    return comp.write_back(part_person(spark, sf), _whole(spark, sf), "id",
                           {"component": "author_partition"})


@entry("edited_distribution", """
with sizes as (select count(o_orderkey) + 1 as size from customer left join orders
               on o_custkey = c_custkey group by c_custkey)
select count(*) as set_count, """ + ", ".join(
    f"quantile_disc(size, {p / 100}) as p{p}" for p in stats.PERCENTILES) + " from sizes")
def _(spark, sf):
    people = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    labels = comp.bipartite_components(
        editor(spark, sf), vertices=comp.tagged_vertices(people, publication(spark, sf)))
    return stats.size_distribution(comp.component_sizes(labels))


@entry("person_partition_above", f"""
with recursive {PART_AUTHOR}, {_GRAPH}, {_above_sql(0.5)}, {_labels_sql('e', 'label')}
select p_partkey as id, p_name as full_name, component as author_partition
from part left join label on label.id = p_partkey""")
def _(spark, sf):
    edges = coauthor.edges_above(part_author(spark, sf), 0.5)
    labels = comp.components_above(edges, [0.5])
    return comp.write_back(part_person(spark, sf), labels, "id",
                           {"component": "author_partition"})


# --- graph files ---------------------------------------------------------------------------------
def _graph_tables(spark, sf):
    """Driver tables under the names of the export."""
    return {
        "person": part_person(spark, sf),
        "publication": publication(spark, sf),
        "school": load(spark, sf, "nation").select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")),
        "author": part_author(spark, sf),
        "editor": editor(spark, sf),
    }


@entry("graph_nodes_rels", f"""
with {PART_AUTHOR}
select 'node' as kind, 'Person' as entity, 'id:ID(person-ID), full_name' as header,
  count(*) as rows from part
union all select 'node', 'Publication',
  'key:ID(publication-ID), title, booktitle, journal, pages, year:int', count(*)
  from orders
union all select 'node', 'School', 'id:ID(school-ID), name', count(*) from nation
union all select 'relationship', 'authored',
  ':START_ID(person-ID), :END_ID(publication-ID)', count(*) from author
union all select 'relationship', 'edited',
  ':START_ID(person-ID), :END_ID(publication-ID)', count(*) from orders""")
def _(spark, sf):
    return graphfiles.graph_file_summary(_graph_tables(spark, sf))


@entry("graph_rel_rows", f"""
with {PART_AUTHOR}
select person_id as ":START_ID(person-ID)", publication_key as ":END_ID(publication-ID)"
from author""")
def _(spark, sf):
    return graphfiles.graph_file("author", part_author(spark, sf))


@entry("graph_counts", f"""
with {PART_AUTHOR}
select 'nodes' as kind, (select count(*) from part) + (select count(*) from orders)
  + (select count(*) from nation) as n
union all select 'relationships', (select count(*) from author) + (select count(*) from orders)
""")
def _(spark, sf):
    return graphfiles.graph_counts(_graph_tables(spark, sf))
