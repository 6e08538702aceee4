"""Writers and readers of results."""

from __future__ import annotations

import json
import logging
from datetime import datetime
from typing import Any
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlight.sources.schema import SIGNALS


def write_signals_csv(signals: DataFrame, path: str) -> None:
    """One CSV file with a header, in order of window and market: windows are few next to posts."""
    signals.orderBy("window_start", "market").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_signals_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SIGNALS).option("header", True).csv(path)


_COLOURS = ("#1f77b4", "#ff7f0e", "#2ca02c", "#d62728", "#9467bd")


def signals_svg(series: dict[str, list[tuple[datetime, float, float, float]]], title: str, width: int = 1200, height: int = 600) -> str:
    """A line and an interval band for each market, over a zero line."""
    times = [t for points in series.values() for t, *_ in points]
    first, last = min(times, default=datetime(2000, 1, 1)), max(times, default=datetime(2000, 1, 2))
    span = max((last - first).total_seconds(), 1.0)
    x = lambda t: 70 + (width - 200) * (t - first).total_seconds() / span
    y = lambda v: height - 50 - (height - 100) * (v + 1) / 2
    out = [f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}" font-family="sans-serif" font-size="12"><rect width="100%" height="100%" fill="white"/>', f'<text x="{width / 2}" y="25" text-anchor="middle" font-size="16">{escape(title)}</text>']
    for v in (-1, -0.5, 0, 0.5, 1):
        out.append(f'<line x1="70" x2="{width - 130}" y1="{y(v):.1f}" y2="{y(v):.1f}" stroke="{"#333" if v == 0 else "#ddd"}"/><text x="60" y="{y(v) + 4:.1f}" text-anchor="end">{v:g}</text>')
    for k, (market, points) in enumerate(sorted(series.items())):
        colour = _COLOURS[k % len(_COLOURS)]
        band = [*((t, high) for t, _, _, high in points), *((t, low) for t, _, low, _ in reversed(points))]
        out.append(f'<polygon points="{" ".join(f"{x(t):.1f},{y(v):.1f}" for t, v in band)}" fill="{colour}" opacity="0.12"/>')
        out.append(f'<polyline points="{" ".join(f"{x(t):.1f},{y(v):.1f}" for t, v, *_ in points)}" fill="none" stroke="{colour}"/><text x="{width - 120}" y="{60 + 18 * k}" fill="{colour}">{escape(market)}</text>')
    out.append(f'<text x="70" y="{height - 25}">{first:%Y-%m-%d %H:%M}</text><text x="{width - 130}" y="{height - 25}" text-anchor="end">{last:%Y-%m-%d %H:%M} UTC</text></svg>')
    return "\n".join(out)


def plot_signals(sampled: DataFrame, path: str, title: str = "Market social composite signal") -> None:
    """Draws sampled signals, which are fewer than 1,200 points a market, to one SVG written by Spark."""
    series: dict[str, list[tuple[datetime, float, float, float]]] = {}
    for r in sampled.orderBy("market", "window_start").select("market", "window_start", "composite_signal", "ci95_lower", "ci95_upper").toLocalIterator():
        series.setdefault(r[0], []).append((datetime.fromisoformat(r[1]), *r[2:]))
    sampled.sparkSession.createDataFrame([(signals_svg(series, title),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_json(one_row: DataFrame, path: str) -> None:
    """A table of one row as JSON."""
    one_row.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path).first()["value"])


def write_vectors(vectors: DataFrame, path: str) -> None:
    """Ids and vectors in the same rows."""
    vectors.write.mode("overwrite").option("compression", "zstd").parquet(path)


class JsonLines(logging.Formatter):
    """A log record as one line of JSON."""

    EXTRA = ("event", "count", "query", "path", "attempt")

    def format(self, record: logging.LogRecord) -> str:
        out = {"timestamp": self.formatTime(record, "%Y-%m-%dT%H:%M:%S%z"), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        out |= {k: getattr(record, k) for k in self.EXTRA if hasattr(record, k)}
        if record.exc_info:
            out["exception"] = self.formatException(record.exc_info)
        return json.dumps(out, ensure_ascii=False, default=str)


def configure_logging(level: str = "INFO") -> None:
    handler = logging.StreamHandler()
    handler.setFormatter(JsonLines())
    root = logging.getLogger("fernlight")
    root.handlers[:] = [handler]
    root.setLevel(level.upper())
