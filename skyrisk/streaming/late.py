"""Observations that arrive late or again, as a stream: days are emitted once they are complete.

State is kept for an area and day: of each point, the latest load seen. When every point of the
area has reported, the rows go out; what stays is the load of each, so that a later load of a
point goes out as a correction. When the watermark has passed the day, what is left of an
incomplete day goes out and the state is dropped, and rows older than that are ignored. So state
is bounded by the points of the areas and the days within the delay. Taking the latest load of
the rows that went out gives what a batch gives, for files in any order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

MEASURES = ["temperature_2m_mean", "precipitation_sum"]
OUTPUT = "numero_departement string, jour date, code_insee string, insere_a timestamp, row_hash string, complet boolean"
STATE = "codes array<string>, loads array<timestamp>, hashes array<string>, measures array<array<double>>, sent boolean"


def arriving(raw: DataFrame, points: DataFrame, delay: str = "10 days") -> DataFrame:
    """Raw observations with their area and the number of points it has. The seed of points is
    static; its join is broadcast or not by its size."""
    area = points.select(F.trim("code_insee").alias("code_insee"), "numero_departement")
    sizes = area.groupBy("numero_departement").agg(F.count_distinct("code_insee").alias("attendus"))
    rows = raw.withWatermark("time", delay).withColumn("code_insee", F.trim("code_insee"))
    return rows.join(area.join(sizes, "numero_departement"), "code_insee")


def complete_days(arrived: DataFrame, measures: list[str] | None = None) -> DataFrame:
    """Rows of area-days that became complete, corrections, and rows of days that ran out."""
    measures = measures or MEASURES
    schema = OUTPUT + "".join(f", {m} double" for m in measures)

    def follow(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        area, day = key
        held: dict[str, tuple] = {}
        sent = False
        if state.exists:
            codes, loads, hashes, values, sent = state.get
            held = {c: (load, h, tuple(v)) for c, load, h, v in zip(codes, loads, hashes, values, strict=True)}

        def out(rows: list[tuple], complete: bool) -> pd.DataFrame:
            frame = pd.DataFrame([(area, day, c, load, h, complete, *v) for c, (load, h, v) in rows], columns=[f.split()[0] for f in schema.split(", ")])
            return frame

        if state.hasTimedOut:
            state.remove()
            if not sent and held:
                yield out(sorted(held.items()), False)
            return
        changed, expected = set(), 0
        for chunk in chunks:
            for row in chunk.itertuples(index=False):
                r = row._asdict()
                load = (pd.Timestamp(r["insere_a"]), r["row_hash"])
                expected = int(r["attendus"])
                known = held.get(r["code_insee"])
                if known is None or load > (pd.Timestamp(known[0]), known[1]):
                    held[r["code_insee"]] = (*load, tuple(float(r[m]) if r[m] is not None else float("nan") for m in measures))
                    changed.add(r["code_insee"])
        if sent:
            rows = sorted((c, held[c]) for c in changed)
        else:
            sent = len(held) >= expected
            rows = sorted(held.items()) if sent else []
        state.update((list(held), [v[0] for v in held.values()], [v[1] for v in held.values()], [list(v[2]) for v in held.values()], sent))
        # The state of a day ends when the watermark passes it; a day already passed ends next.
        state.setTimeoutTimestamp(max(int(pd.Timestamp(day).timestamp() * 1000) + 86_400_000, state.getCurrentWatermarkMs() + 1))
        if rows:
            yield out(rows, True)

    grouped = arrived.withColumn("jour", F.to_date("time")).groupBy("numero_departement", "jour")
    return grouped.applyInPandasWithState(follow, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)
