"""Run queries next to their SQL and compare schema names, row counts and values."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return int(value) if value.is_integer() else round(value, 9)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(df, con, sql):
    """None if both agree, else a short account of the difference."""
    got_columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_columns, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} vs {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(bad)} of {len(got)} rows differ: {bad[0]}" if bad else None
