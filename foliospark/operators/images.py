"""Image links in Markdown and the recognised text that is put behind them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X

# Fixed value: a link reaches to the last parenthesis on its line, for paths with parentheses.
LINK = r"(?d)!\[[^\]]*\]\(.+\)"
FAILED = "[OCR Failed]"


def links(text: Column) -> Column:
    """ARRAY<STRUCT<match, path>> of a text's image links, in order."""
    found = F.regexp_extract_all(text, F.lit(LINK), F.lit(0))
    return F.transform(found, lambda m: F.struct(m.alias("match"), F.regexp_extract(m, r"(?s)^!\[[^\]]*\]\((.*)\)$", 1).alias("path")))


def existing_links(df: DataFrame, key: str, text: str, assets: DataFrame, asset_key: str, path: str) -> DataFrame:
    """(key, n, match, path) of the links whose target is among the document's assets; n counts links from 0."""
    each = df.select(key, F.posexplode(links(F.col(text))).alias("n", "l")).select(key, "n", "l.match", "l.path")
    return each.join(assets.select(F.col(asset_key).alias(key), F.col(path).alias("path")).distinct(), [key, "path"], "left_semi").select(key, "n", "match", "path")


def recognised(response: Column) -> Column:
    """The text in a model's JSON response; a mark where there is none."""
    return F.coalesce(F.get_json_object(response, "$.response.candidates[0].content.parts[0].text"), F.lit(FAILED))


def inject(df: DataFrame, key: str, text: str, results: DataFrame, strip: bool = False) -> DataFrame:
    """``df`` with recognised text behind every occurrence of the links it belongs to.

    ``results`` has (key, n, match, result); of several for one link the first by n counts, and links are served in
    order of n. Texts without results stay as they are. A document has a bounded number of links.
    """
    body = F.trim(F.col("result")) if strip else F.col("result")
    found = X.fresh(df.columns, "_r")
    first = results.filter("match is not null and result is not null").groupBy(key, "match").agg(F.min(F.struct("n", body.alias("result"))).alias("r"))
    per = first.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col("r.n").alias("n"), "match", F.col("r.result").alias("result")))).alias(found))
    kind = df.schema[text].dataType

    @F.arrow_udf(kind)
    def put(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, rs in zip(texts.to_pylist(), found.to_pylist()):
            for r in rs or () if t is not None else ():
                t = t.replace(r["match"], f"{r['match']}\n\n{r['result']}\n\n")
            out.append(t)
        return pa.array(out, pa.string())

    return df.join(per, key, "left").withColumn(text, put(F.col(text), F.col(found))).drop(found)


def requests(links_: DataFrame, key: str, assets: DataFrame, prompt: str) -> DataFrame:
    """(request_id, line): one JSON line a link for a batch service, with the image in base64."""
    met = links_.join(assets, [key, "path"])
    id_ = F.concat(F.col(key).cast("string"), F.lit("---"), F.col("n").cast("string"))
    part = F.struct(F.lit(prompt).alias("text")), F.struct(F.base64("content").alias("data"))
    line = F.struct(id_.alias("request_id"), F.struct(part[0].alias("instruction"), part[1].alias("image")).alias("request"))
    return met.select(id_.alias("request_id"), F.to_json(line).alias("line"))
