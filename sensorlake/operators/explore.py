"""Explorer-side data work: faceted filters, location levels, display orders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.text import floor_class, floor_code, section


def facet_filter(df: DataFrame, metrics: Sequence[str], sections: Sequence[int],
                 sources: Mapping[str, bool | Sequence[str]], global_metrics: Sequence[str] = (),
                 metric_col: str = "data_key", source_col: str = "source", location_col: str = "location") -> DataFrame:
    """conjunction of facets.

    * metric in the chosen metrics;
    * section (last character of the location) in the chosen sections,
      except for ``global`` metrics, which ignore the section facet;
    * per source: ``True``/``False`` switches a simple source on/off, a list
      chooses floors of a hierarchical source (only NP/PP floors count).
    """
    loc = F.col(location_col)
    cond = F.col(metric_col).isin(list(metrics))
    sec_ok = section(loc).isin([int(s) for s in sections]) if sections else F.lit(False)
    if global_metrics:
        sec_ok = F.col(metric_col).isin(list(global_metrics)) | sec_ok
    cond = cond & F.coalesce(sec_ok, F.lit(False))
    src: Column = F.lit(False)
    for name, choice in sources.items():
        if isinstance(choice, bool):
            if choice:
                src = src | (F.col(source_col) == name)
        else:
            floors = [f for f in choice if ("NP" in f or "PP" in f)]
            if floors:
                src = src | ((F.col(source_col) == name) & floor_code(loc).isin(floors))
    return df.filter(cond & F.coalesce(src, F.lit(False)))


def with_levels(df: DataFrame, location_col: str = "location") -> DataFrame:
    """All location levels of a row as columns."""
    loc = F.col(location_col)
    return df.withColumns({"section": section(loc), "floor": floor_code(loc), "floor_class": floor_class(loc)})


def explore(df: DataFrame, metrics: Sequence[str], sections: Sequence[int], sources: Mapping[str, bool | Sequence[str]],
            grain: str = "day", global_metrics: Sequence[str] = (), aggregate_location_keys: Sequence[str] = (),
            source_priority: Mapping[str, int] | None = None, metric_order: Mapping[str, int] | None = None) -> DataFrame:
    """The explorer's data path: facets (F10) -> max/avg/min per period and
    chart line (A09; listed metrics merge all locations into one line) ->
    display ranks of the lines (O06). One scan, one aggregate."""
    from sensorlake.operators.aggregates import envelope
    from sensorlake.operators.ordering import display_order
    f = facet_filter(df, metrics, sections, sources, global_metrics)
    env = envelope(f, grain, line_cols=("source", "location", "data_key"), aggregate_location_keys=aggregate_location_keys)
    return display_order(env, source_priority or {}, metric_order or {})
