"""Workflow graphs kept as JSON: nodes, links, dependencies and what they lack."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.operators.joins import variant_overlap

_NODES = "map<string, struct<class_type: string, inputs: map<string, string>>>"


def nodes(workflows: DataFrame) -> DataFrame:
    """``workflow_id, node, class_type, inputs`` from ``workflow_id, graph`` (JSON). What is no node is left out.

    Inputs are a map of names to JSON texts; a link is a text such as ``["4", 0]``.
    """
    parsed = workflows.select("workflow_id", F.explode(F.from_json("graph", _NODES)).alias("node", "n"))
    return parsed.where("n.class_type is not null").select("workflow_id", "node", "n.class_type", "n.inputs")


def inputs(all_nodes: DataFrame) -> DataFrame:
    """``workflow_id, node, class_type, field, value, link_to``: one row an input; ``link_to`` is the node it comes from."""
    rows = all_nodes.select("workflow_id", "node", "class_type", F.explode("inputs").alias("field", "value"))
    return rows.withColumn("link_to", F.nullif(F.regexp_extract("value", r'^\[\s*"([^"]+)"\s*,\s*[0-9]+\s*\]$', 1), F.lit("")))


def model_needs(all_inputs: DataFrame, loaders: DataFrame) -> DataFrame:
    """``workflow_id, node, folder, model``: inputs that name a file, by a table ``class_type, field, folder``; links are none."""
    return all_inputs.where("link_to is null").join(loaders, ["class_type", "field"]).where("value <> ''").select("workflow_id", "node", "folder", F.col("value").alias("model"))


def embedding_refs(all_inputs: DataFrame, fields: Sequence[str] = ("text", "prompt")) -> DataFrame:
    """``workflow_id, node, name`` of embeddings named in prompts."""
    found = F.explode(F.regexp_extract_all("value", F.lit(r"embedding:([A-Za-z0-9_.\-/]+)"), F.lit(1)))
    return all_inputs.where(F.col("field").isin(*fields)).select("workflow_id", "node", found.alias("name")).distinct()


def listed_models(answers: DataFrame) -> DataFrame:
    """``folder, model`` from lists whose entries are texts or objects with a name."""
    v = F.explode(F.from_json("models", "array<string>")).alias("m")
    name = F.coalesce(F.get_json_object("m", "$.name"), F.get_json_object("m", "$.filename"), F.when(~F.col("m").startswith("{"), F.col("m")))
    return answers.select("folder", v).select("folder", name.alias("model")).where("model is not null")


def model_variants(model: Column) -> Column:
    """Spellings under which a model file may be known: as it is, without folder, without suffix."""
    base = F.element_at(F.split(F.replace(model, F.lit("\\"), F.lit("/")), "/"), -1)
    stem = F.regexp_replace(base, r"\.[A-Za-z0-9]{2,12}$", "")
    return F.array_distinct(F.transform(F.array(model, base, stem), lambda x: F.lower(x)))


def missing_models(needs: DataFrame, installed: DataFrame) -> DataFrame:
    """Needs whose variants meet no installed model's in its folder."""
    a = needs.select(F.concat_ws("|", "folder", "model").alias("need"), F.transform(model_variants(F.col("model")), lambda x: F.concat_ws("|", F.col("folder"), x)).alias("v")).distinct()
    b = installed.select(F.concat_ws("|", "folder", "model").alias("have"), F.transform(model_variants(F.col("model")), lambda x: F.concat_ws("|", F.col("folder"), x)).alias("v")).distinct()
    met = variant_overlap(a, "need", "v", b, "have", "v").select("need")
    return needs.withColumn("need", F.concat_ws("|", "folder", "model")).join(met, "need", "left_anti").drop("need")


def missing_classes(all_nodes: DataFrame, installed: DataFrame) -> DataFrame:
    """Classes that workflows need and that are not installed."""
    return all_nodes.select("workflow_id", "class_type").distinct().join(installed.select("class_type"), "class_type", "left_anti")


def output_files(history: DataFrame) -> DataFrame:
    """``run_id, n_files`` from a JSON map of nodes to lists of outputs."""
    m = F.from_json("outputs", "map<string, array<string>>")
    return history.select("run_id", F.coalesce(F.aggregate(F.map_values(m), F.lit(0), lambda n, x: n + F.size(x)), F.lit(0)).cast("bigint").alias("n_files"))
