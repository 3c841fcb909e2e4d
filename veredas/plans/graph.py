"""The property graph as two DataFrames, and the assertions over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.graph import edge_name, frozen_edge_name, node_label, relation
from ..operators.relational import top_per_group
from ..operators.walk import simple_paths, without_incoming
from ..sources.writers import matched_edges


def graph_nodes(companies: DataFrame, persons: DataFrame, served: DataFrame) -> DataFrame:
    """(id, labels, name, tipo, motivo): companies, persons and every other owner that edges name.

    An id may be a state and a company at once; the two stay two nodes.
    """
    seed = F.col("motivo_entrada_categoria") == "semente"
    firm = companies.select(
        F.col("cnpj").alias("id"), F.array(F.lit("Empresa"), F.when(seed, "Semente").otherwise("Holding")).alias("labels"), F.col("razao_social").alias("name"),
        F.lit("empresa").alias("tipo"), F.col("motivo_entrada_categoria").alias("motivo"),
    )
    human = persons.select(F.col("pessoa_id").alias("id"), F.array(F.lit("Pessoa")).alias("labels"), F.col("nome").alias("name"), F.lit("pessoa").alias("tipo"), F.lit(None).cast("string").alias("motivo"))
    ends = top_per_group(served.select(F.col("origem_id").alias("id"), "origem_tipo", F.col("origem_nome").alias("name")).distinct(), ["id", "origem_tipo"], [F.col("name")])
    known = firm.select("id", "tipo").unionByName(human.select("id", "tipo")).withColumnRenamed("tipo", "origem_tipo")
    other = ends.join(known, ["id", "origem_tipo"], "left_anti").select("id", F.array(node_label("origem_tipo")).alias("labels"), "name", F.col("origem_tipo").alias("tipo"), F.lit(None).cast("string").alias("motivo"))
    return firm.unionByName(human).unionByName(other)


def graph_edges(served: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(from_id, from_label, to_id, rel, name, ...): one edge per served row of the three roles.

    With ``nodes`` only edges come out whose owner is a node of its label and whose company is a company node.
    """
    rel = relation("papel")
    out = served.select(
        F.col("origem_id").alias("from_id"), node_label("origem_tipo").alias("from_label"), F.col("cnpj").alias("to_id"), rel.alias("rel"),
        edge_name("papel", "fonte", "percentual_on", "percentual_total").alias("name"), "papel", "fonte", "percentual_on", "percentual_total", "qualificacao",
        "fonte_documento", F.col("data_referencia").cast("string").alias("data_referencia"), "tem_informacao_de_controle",
    )
    edges = out.where("rel != 'VINCULO'")
    if nodes is None:
        return edges
    ends = nodes.select(F.col("id").alias("from_id"), F.element_at("labels", 1).alias("from_label")).distinct()
    firms = nodes.where(F.element_at("labels", 1) == "Empresa").select(F.col("id").alias("to_id")).distinct()
    return edges.join(ends, ["from_id", "from_label"], "left_semi").join(firms, "to_id", "left_semi").select(*edges.columns)


def owners_of(nodes: DataFrame, edges: DataFrame, company: str) -> DataFrame:
    """A company's incoming edges with their owners, by relation, share and name; one row without owner if there are none."""
    firm = nodes.where((F.col("id") == company) & F.array_contains("labels", "Empresa")).select(F.col("id").alias("to_id"), F.col("name").alias("empresa"), "motivo")
    named = nodes.select(F.col("id").alias("from_id"), F.element_at("labels", 1).alias("from_label"), F.col("name").alias("titular"))
    into = edges.join(named, ["from_id", "from_label"]).select("to_id", F.col("from_label").alias("origem"), "titular", "rel", F.col("name").alias("descricao"), "fonte", "percentual_on")
    return firm.join(into, "to_id", "left").orderBy("rel", F.coalesce("percentual_on", F.lit(-1.0)).desc(), "titular")


def owners_report(nodes: DataFrame, edges: DataFrame, company: str, most: int = 14) -> DataFrame:
    """(ordem, origem, rel, descricao, titular): the first ``most`` owners of a company and, if there are more, a row that says how many."""
    owners = owners_of(nodes, edges, company).where("titular is not null or rel is not null").select("origem", "rel", "descricao", "titular", "percentual_on")
    order = [F.col("rel"), F.coalesce("percentual_on", F.lit(-1.0)).desc(), F.col("titular"), F.col("descricao")]
    top = owners.orderBy(*order).limit(most).withColumn("ordem", F.row_number().over(Window.orderBy(*order)))
    rest = owners.agg((F.count(F.lit(1)) - most).alias("n")).where("n > 0")
    none = F.lit(None).cast("string")
    more = rest.select(F.lit(most + 1).alias("ordem"), none.alias("origem"), none.alias("rel"), F.concat(F.lit("… "), F.col("n").cast("string"), F.lit(" more")).alias("descricao"), none.alias("titular"))
    return top.select("ordem", "origem", "rel", "descricao", "titular").unionByName(more)


def owner_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, titulares, controladores, estados): the owners of every seed and holding, of all kinds, controlling and states; 0 where there are none."""
    firms = nodes.where(F.size("labels") > 1).select("id")
    into = edges.groupBy(F.col("to_id").alias("id")).agg(
        F.count(F.lit(1)).alias("titulares"), F.count_if(F.col("rel") == "CONTROLADOR").alias("controladores"), F.count_if(F.col("from_label") == "Estado").alias("estados")
    )
    return firms.join(into, "id", "left").fillna(0, ["titulares", "controladores", "estados"])


def company_checks(
    nodes: DataFrame, edges: DataFrame, company: str, present: Sequence[tuple[str, str]] = (), absent: Sequence[tuple[str, str]] = (), walk_past: bool = False
) -> DataFrame:
    """(verificacao, valor, ok) about one company: that it has owners, has one of a label and name pattern or has none of them.

    With ``walk_past`` also that control leads on from it to a person or a state.
    """
    owners = owners_of(nodes, edges, company).where("rel is not null").select("origem", F.upper(F.coalesce("titular", F.lit(""))).alias("titular"))
    counts = [F.count(F.lit(1))] + [F.count_if((F.col("origem") == label) & F.col("titular").rlike(pattern)) for label, pattern in (*present, *absent)]
    n = list(owners.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts)]).first())
    found = [(f"{company} has owners", n[0], n[0] > 0)]
    found += [(f"{company} has a {label} like {pattern}", n[1 + i], n[1 + i] > 0) for i, (label, pattern) in enumerate(present)]
    found += [(f"{company} has no {label} like {pattern}", v, v == 0) for (label, pattern), v in zip(absent, n[1 + len(present) :])]
    if walk_past:
        reached = control_paths(nodes, edges, company).count()
        found.append((f"{company} leads to a person or a state", reached, reached > 0))
    return nodes.sparkSession.createDataFrame(found, "verificacao string, valor long, ok boolean")


def require_checks(checks: DataFrame) -> None:
    """Fails and names the checks that are not ok."""
    failed = [f"{r.verificacao} ({r.valor})" for r in checks.where("not ok").collect()]
    if failed:
        raise ValueError("graph: " + "; ".join(failed))


def control_paths(nodes: DataFrame, edges: DataFrame, company: str, most: int = 6, rows: int = 6) -> DataFrame:
    """The shortest control paths that lead from a person or a state to a company."""
    control = edges.where("rel = 'CONTROLADOR'").select(F.col("from_id").alias("here"), F.col("to_id").alias("there"))
    target = nodes.where((F.col("id") == company) & F.array_contains("labels", "Empresa")).select(F.col("id").alias("node"))
    stops = nodes.where(F.array_contains("labels", "Pessoa") | F.array_contains("labels", "Estado")).select(F.col("id").alias("start"), F.element_at("labels", 1).alias("origem"), F.col("name").alias("titular"))
    return simple_paths(control, target, most).join(stops, "start").select("origem", "titular", "hops", "trail").orderBy("hops", "titular").limit(rows)


def label_histogram(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.explode("labels").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def relation_histogram(edges: DataFrame) -> DataFrame:
    return edges.groupBy("rel").agg(F.count(F.lit(1)).alias("n"))


def graph_checks(nodes: DataFrame, edges: DataFrame, served: DataFrame) -> DataFrame:
    """(verificacao, valor, ok): invariants of the graph; every row should be ok."""
    spark = nodes.sparkSession
    labels = {r["label"]: r["n"] for r in label_histogram(nodes).collect()}
    rels = {r["rel"]: r["n"] for r in relation_histogram(edges).collect()}
    union = F.upper("name").rlike("UNI[ÃA]O")
    person_union = nodes.where(F.array_contains("labels", "Pessoa") & union).count()
    state_union = nodes.where(F.array_contains("labels", "Estado") & union).count()
    qsa = edges.where("rel = 'SOCIO' and fonte = 'qsa'").agg(F.count_if(F.col("percentual_on").isNotNull()), F.count_if(F.col("papel") == "acionista_controlador")).first()
    rows = served.count()
    lonely = without_incoming(
        nodes.where("motivo = 'semente'").select(F.col("id").alias("node")), edges.select(F.col("from_id").alias("here"), F.col("to_id").alias("there"))
    ).count()
    found = [(f"nodes labelled {n}", labels.get(n, 0), labels.get(n, 0) > 0) for n in ("Pessoa", "Empresa", "Semente", "Holding", "Estado")]
    found += [(f"edges {n}", rels.get(n, 0), rels.get(n, 0) > 0) for n in ("CONTROLADOR", "SOCIO")]
    found += [
        ("edges equal served rows", sum(rels.values()), sum(rels.values()) == rows), ("edges point at a company", sum(rels.values()), sum(rels.values()) > 0), ("the Union is no person", person_union, person_union == 0),
        ("the Union is a state", state_union, state_union > 0), ("partner lists have no shares", qsa[0], qsa[0] == 0),
        ("partner lists have no controller", qsa[1], qsa[1] == 0), ("seeds without owner", lonely, True),
    ]
    return spark.createDataFrame(found, "verificacao string, valor long, ok boolean")


def frozen_graph(graph: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a frozen graph file with arrays ``nodes`` and ``edges``.

    Persons and all others are told apart by kind; of repeated nodes, and of
    repeated edges between two nodes, the last counts; edges with an end that is
    no node are dropped.
    """
    nodes = graph.select(F.posexplode("nodes").alias("_o", "n")).select("_o", "n.*")
    edges = graph.select(F.posexplode("edges").alias("_o", "e")).select("_o", "e.*")
    label = F.when(F.col("kind") == "person", "Pessoa").otherwise("Empresa")
    last_nodes = top_per_group(nodes.withColumn("labels", F.array(label)), ["id"], [F.desc("_o")]).drop("_o")
    for missing in ("kind", "pct_votos"):
        if missing not in edges.columns:
            edges = edges.withColumn(missing, F.lit(None).cast("double" if missing == "pct_votos" else "string"))
    last_edges = top_per_group(edges, ["from", "to"], [F.desc("_o")]).drop("_o").withColumn("name", frozen_edge_name("kind", "pct_votos"))
    return last_nodes, matched_edges(last_edges, last_nodes, "from", "to", "id")
