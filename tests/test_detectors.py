"""Stream detectors: a hot key in one batch, state over batches, and the row-by-row definitions."""

import math
import uuid

import numpy as np
import pandas as pd
import pytest

from tabwright.streaming import detectors, ingest

SCHEMA = "k string, ts timestamp, id long, v double"


def run(spark, tmp_path, frames, detector, per_trigger=None):
    """``frames`` land one after the other and are consumed, each in a batch of its own if ``per_trigger`` is 1."""
    base = tmp_path / uuid.uuid4().hex
    for i, pdf in enumerate(frames):
        spark.createDataFrame(pdf, SCHEMA).repartition(3).write.mode("append").parquet(str(base / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(base / "in"))
        ingest.run_available(detector(stream), str(base / "out"), str(base / "ckpt"))
    return spark.read.parquet(str(base / "out")).toPandas().sort_values(["k", "id"], ignore_index=True)


def events(n, keys, seed=0):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"k": keys, "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n) // 3, unit="s"), "id": np.arange(n), "v": np.round(rng.normal(5, 2, n) + (np.arange(n) > n // 2) * 1.5, 3)})
    return pdf.sample(frac=1.0, random_state=seed, ignore_index=True)


def by_hand(values, delta, threshold):
    n, mean, total, low, out = 0, 0.0, 0.0, 0.0, []
    for v in values:
        n += 1
        mean += (v - mean) / n
        total += v - mean - delta
        low = min(low, total)
        out.append((total - low, total - low > threshold))
    return out


def test_a_key_of_a_million_rows_in_one_batch(spark, tmp_path):
    """Rows come in no order, three to a time; the pieces put by in the state are merged in time order."""
    n = 1_000_000
    got = run(spark, tmp_path, [events(n, "hot")], lambda s: detectors.page_hinkley(s, "k", "ts", "v", 0.05, 50.0, tie="id"))
    v = events(n, "hot").sort_values("id")["v"].to_numpy()
    mean = np.cumsum(v) / np.arange(1, n + 1)
    total = np.cumsum(v - mean - 0.05)
    stat = total - np.minimum(0.0, np.minimum.accumulate(total))
    assert len(got) == n and (got["id"] == np.arange(n)).all()
    np.testing.assert_allclose(got["statistic"], stat, rtol=1e-9, atol=1e-6)
    assert (got["drift"] == (stat > 50)).all() and got["drift"].any()


def test_state_goes_on_over_batches(spark, tmp_path):
    pdf = events(600, np.where(np.arange(600) % 3 == 0, "a", "b"))
    halves = [pdf[pdf["id"] < 250], pdf[pdf["id"] >= 250]]
    got = run(spark, tmp_path, halves, lambda s: detectors.page_hinkley(s, "k", "ts", "v", 0.05, 20.0, tie="id"))
    for k, rows in pdf.sort_values("id").groupby("k"):
        want = by_hand(rows["v"], 0.05, 20.0)
        mine = got[got["k"] == k]
        np.testing.assert_allclose(mine["statistic"], [s for s, _ in want], atol=1e-9)
        assert mine["drift"].tolist() == [d for _, d in want]


def test_error_rate_detector(spark, tmp_path):
    pdf = events(900, "x")
    pdf["v"] = ((pdf["id"] > 500) & (pdf["id"] % 2 == 0) | (pdf["id"] % 9 == 0)).astype(float)
    got = run(spark, tmp_path, [pdf[pdf["id"] < 400], pdf[pdf["id"] >= 400]], lambda s: detectors.ddm(s, "k", "ts", "v", tie="id"))
    n = e = 0
    best, want = None, []
    for v in pdf.sort_values("id")["v"]:
        n, e = n + 1, e + v
        p = e / n
        s = math.sqrt(p * (1 - p) / n)
        if n >= 30 and (best is None or p + s < sum(best)):
            best = (p, s)
        want.append((p + s, best is not None and p + s > best[0] + 3 * best[1]))
    np.testing.assert_allclose(got["statistic"], [s for s, _ in want])
    assert got["drift"].tolist() == [d for _, d in want] and got["drift"].any()


def test_adaptive_window_shrinks_at_a_change(spark, tmp_path):
    pdf = events(1200, "x", 4)
    pdf["v"] = np.where(pdf["id"] < 700, 0.0, 1.0) + pdf["v"] * 0.05
    got = run(spark, tmp_path, [pdf], lambda s: detectors.adaptive_window(s, "k", "ts", "v", tie="id"))
    assert got["statistic"].iloc[699] == 700 and got["drift"].iloc[700:].any() and got["statistic"].iloc[-1] < 700


@pytest.mark.parametrize("pieces", [1, 3, 50])
def test_merge_of_pieces(pieces, monkeypatch):
    """Runs of unlike lengths with equal times: every row once, in order."""
    monkeypatch.setattr(detectors, "PIECE_ROWS", pieces)

    class Store(dict):
        updateValue, getValue, removeKey = dict.__setitem__, dict.__getitem__, dict.__delitem__

    rng = np.random.default_rng(1)
    worker = detectors.Detector("k", ["ts", "id"], "v", None, None, None)
    worker.pieces = Store()
    rows = pd.DataFrame({"ts": rng.integers(0, 9, 230), "id": np.arange(230), "v": rng.normal(size=230)}).sample(frac=1.0, random_state=2)
    frames = [rows[a:b] for a, b in ((0, 7), (7, 7), (7, 120), (120, 121), (121, 230))]
    got = pd.concat(list(worker._in_order(iter(frames))), ignore_index=True)
    pd.testing.assert_frame_equal(got, rows.sort_values(["ts", "id"], ignore_index=True))
    assert worker.pieces == {}
