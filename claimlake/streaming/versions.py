"""ST2 with the stream's own state: what each claim has come to, without a look at the stored tables.

Records of a claim (claim_id, frequency_code, arrival timestamp and values) may come in any order and over any
number of batches; a claim always comes to what E1 and E2 make of all its records in order of arrival. Its state
is three turns, each a minimum or maximum and so free of the order of coming: that of the first record, which
inserts it, of the last replacement (code 7) and of the last void (code 8). An original that comes after its
replacement moves the first turn alone, so it is ignored but for the status; a repeat changes nothing. A record
that is sent twice, alike in all values, counts once (E1 takes the second of a first void or replacement as one more).

The stream's output is a log of changes, which the file sink writes exactly once; a change has values only if
other ones count from now on. ``current`` gives each claim's last status and last values.

Claims share a group of the state by the hash of their claim_id (BUCKETS of them): a call takes all records of a group
at once, as one call a claim costs a millisecond. A batch rewrites the states of the groups that it touches.

Defined results: ties of arrival go by code, then by values. A null arrival is older than any other; a null
claim_id is an invalid record (V1) and isn't taken. Stored claims come in as records without arrival and code, and
with their status. Records more than ``late`` behind the newest arrival are dropped, and a claim's state ends when
the watermark has passed its newest record: a later replacement of it counts as a new claim, in its place.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Groups of claims; each is a value in the state's store.
BUCKETS = 4096
_STATE = "claims binary"
#: Micro- and milliseconds reach beyond the default format.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
_OLDEST = -(1 << 63)
REPLACES, VOIDS = "7", "8"

Turn = tuple[int, str, int]


def _status(first: Turn, replaced: Turn | None, voided: Turn | None, stored: str | None) -> tuple[Turn, str]:
    """The record whose values count, and the claim's status."""
    live = replaced if replaced is not None and replaced != first else first
    if voided is not None and voided != first and voided > live:
        return live, "voided"
    return live, "corrected" if live != first else stored or "received"


# Of each claim: first, last replacing and last voiding turn, newest arrival, stored status, status, version, end (ms).
Claim = tuple[Turn, Turn | None, Turn | None, int, str | None, str, int, int | None]


def _dump(claims: dict[object, Claim]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps((list(claims), list(zip(*claims.values(), strict=True)))))


def _load(raw: bytes) -> dict[object, Claim]:
    ids, columns = pickle.loads(zstandard.decompress(raw))
    return dict(zip(ids, zip(*columns, strict=True), strict=True))


def _take(old: Claim | None, records: list[tuple[Turn, str, str | None]], watermark: int) -> tuple[Claim, str | None]:
    """A claim after some records, and the values that count from now on, if they are other ones."""
    first, replaced, voided, newest, stored, status, version, _ = old or (None, None, None, _OLDEST, None, None, 0, None)
    before = _status(first, replaced, voided, stored)[0] if old else None
    turns = [r[0] for r in records]
    stored = next((r[2] for r in reversed(records) if r[2] is not None), stored)
    first = min(turns) if first is None else min(first, *turns)
    replaced = max((t for t in (*turns, replaced) if t is not None and t[1] == REPLACES), default=None)
    voided = max((t for t in (*turns, voided) if t is not None and t[1] == VOIDS), default=None)
    newest = max(newest, *[t[0] for t in turns])
    live, now = _status(first, replaced, voided, stored)
    payload = next(r[1] for r in records if r[0] == live) if live != before else None
    ends = None if newest == _OLDEST else max(newest // 1000, watermark) + 1  # a stored claim without records yet has no time to end at
    return (first, replaced, voided, newest, stored, now, version + ((live, now) != (before, status)), ends), payload


def _fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    claims = _load(state.get[0]) if state.exists else {}
    watermark = state.getCurrentWatermarkMs()
    came: dict[object, list[tuple[Turn, str, str | None]]] = {}
    for frame in frames:
        at, code, n, payload, stored, claim = (frame[c].tolist() for c in ("at", "code", "id", "payload", "stored", "claim_id"))
        for c, turn, p, s in zip(claim, zip(at, code, n, strict=True), payload, stored, strict=True):
            came.setdefault(c, []).append((turn, p, s))
    out: list[tuple] = []
    for c, records in came.items():
        old = claims.get(c)
        claims[c], values = _take(old, records, watermark)
        if old is None or claims[c][6] != old[6]:
            out.append((c, claims[c][6], claims[c][3], claims[c][5], values))
    for c in [c for c, of in claims.items() if of[7] is not None and of[7] < watermark]:  # of a claim that came now it is later
        del claims[c]
    if claims:
        state.update((_dump(claims),))
        ends = min((of[7] for of in claims.values() if of[7] is not None), default=None)
        if ends is not None:
            state.setTimeoutTimestamp(ends)
    elif state.exists:
        state.remove()
    if out:
        columns = dict(zip(("claim_id", "version", "newest", "status", "payload"), zip(*out, strict=True), strict=True))
        yield pd.DataFrame(columns | {"payload": pd.Series(columns["payload"], dtype=object)})


def claim_changes(stream: DataFrame, late: str = "400 days", buckets: int = BUCKETS) -> DataFrame:
    """claim_id, version, newest, status and payload (JSON of all further columns, or null) of each change of a claim."""
    values: list[Column] = [F.col(f"`{c}`") for c in stream.columns if c not in ("claim_id", "frequency_code", "arrival", "status")]
    stored = F.col("status") if "status" in stream.columns else F.lit(None).cast("string")
    payload = F.to_json(F.struct(*values), _JSON)
    code = F.coalesce(F.col("frequency_code"), F.lit(""))
    rows = stream.where("claim_id is not null").withWatermark("arrival", late).select("claim_id", "arrival", F.coalesce(F.unix_micros("arrival"), F.lit(_OLDEST)).alias("at"), code.alias("code"), F.xxhash64(payload).alias("id"), payload.alias("payload"), stored.alias("stored"), F.pmod(F.xxhash64("claim_id"), F.lit(buckets)).alias("bucket"))
    out = f"claim_id {rows.schema['claim_id'].dataType.simpleString()}, version long, newest long, status string, payload string"
    return rows.groupBy("bucket").applyInPandasWithState(_fold, out, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def current(changes: DataFrame, values: str) -> DataFrame:
    """claim_id, status and the columns of the schema ``values`` of each claim in a log of changes."""
    turn = F.struct("newest", "version")
    last = changes.groupBy("claim_id").agg(F.max_by("status", turn).alias("status"), F.max_by("payload", F.when(F.col("payload").isNotNull(), turn)).alias("payload"))
    return last.select("claim_id", "status", F.from_json("payload", values, _JSON).alias("v")).select("claim_id", "status", "v.*")
