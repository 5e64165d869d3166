"""Review pages as HTML rows and the review queue as Markdown."""

from __future__ import annotations

import colorsys
import html
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliptide.functions.labels import ACTIONS


def colour(action: str) -> str:
    """A steady colour for an action: hues evenly spread over the vocabulary."""
    k = ACTIONS.index(action) if action in ACTIONS else len(ACTIONS) - 1
    r, g, b = colorsys.hls_to_rgb(k / len(ACTIONS), 0.45, 0.55)
    return f"#{round(255 * r):02x}{round(255 * g):02x}{round(255 * b):02x}"


def geometry(segments: DataFrame) -> DataFrame:
    """segments (start_sec, end_sec, source_duration_sec) with left and width in per cent; half a per cent at least."""
    d = F.nullif(F.col("source_duration_sec"), F.lit(0.0))
    return segments.withColumns({"left_pct": F.lit(100.0) * F.col("start_sec") / d, "width_pct": F.greatest(F.lit(0.5), F.lit(100.0) * (F.col("end_sec") - F.col("start_sec")) / d)})


def pages(segments: DataFrame, key: str = "clip_uid") -> DataFrame:
    """(key, page): one review page per key. A key's segments are one clip's, so a page is bounded by its clip."""
    rows = geometry(segments).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start_sec", "end_sec", "left_pct", "width_pct", "action", "label", F.array_join("quality_flags", ", ").alias("flags")))).alias("rows"))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for name, found in zip(pdf[key], pdf["rows"]):
                bars = "".join(f'<button class="s" style="left:{r["left_pct"]:.3f}%;width:{r["width_pct"]:.3f}%;background:{colour(r["action"])}" data-start="{r["start_sec"]}" title="{html.escape(r["label"] or "", True)}">{html.escape(r["action"])}</button>' for r in found)
                lines = "".join(f"<tr><td>{r['start_sec']:.3f}</td><td>{r['end_sec']:.3f}</td><td>{html.escape(r['action'])}</td><td>{html.escape(r['label'] or '')}</td><td>{html.escape(r['flags'])}</td></tr>" for r in found)
                title = html.escape(str(name))
                out.append(f'<!doctype html><meta charset="utf-8"><title>{title}</title><style>.t{{position:relative;height:3em}}.s{{position:absolute;height:100%;border:0;color:#fff;overflow:hidden}}</style><h1>{title}</h1><div class="t">{bars}</div><table>{lines}</table>')
            yield pd.DataFrame({key: pdf[key], "page": out})

    return rows.mapInPandas(run, f"{key} string, page string")


def index(names: list[str]) -> str:
    return "<!doctype html><meta charset=utf-8><ul>" + "".join(f'<li><a href="{html.escape(n, True)}/review.html">{html.escape(n)}</a></li>' for n in names) + "</ul>"


def stats_page(stats: dict) -> str:
    return f"<!doctype html><meta charset=utf-8><h1>Statistics</h1><pre>{html.escape(json.dumps(stats, indent=2, ensure_ascii=False))}</pre>"


def markdown(review: DataFrame) -> DataFrame:
    """Lines of the review queue (episode_id, reference, predicted, review_reasons) as one Markdown table row each."""
    cell = lambda c: F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")), "\n", " ")
    link = F.concat(F.lit("["), cell(F.col("episode_id")), F.lit("](reports/"), F.col("episode_id"), F.lit("/review.html)"))
    return review.select("episode_id", F.concat(F.lit("| "), F.concat_ws(" | ", link, cell(F.col("reference")), cell(F.col("predicted")), cell(F.array_join("review_reasons", ", "))), F.lit(" |")).alias("line"))
