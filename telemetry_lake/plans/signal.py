"""Measured signal quality against the predicted coverage of the beam a device was in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.times import to_utc
from ..operators.asof import Lookup, asof_join_all
from ..operators.spatial import spatial_join
from ..schemas import BEAM_METRIC, SNR_METRIC

BEAM_WITHIN = dt.timedelta(days=100)
SNR_WITHIN = dt.timedelta(days=1)

#: Property names in the forward-coverage GeoJSON.
COVERAGE_PROPERTIES = {
    "efficiency": "Efficiency",
    "fwd_cn": "FWD_CN (dB)",
    "modCod": "ModCod",
    "modem": "Modem",
    "CoverageBeamName": "Beam Info",
}
#: Property names in the return-coverage GeoJSON.
RETURN_COVERAGE_PROPERTIES = {
    "efficiency": "efficiency",
    "fwd_cn": "fwd_cn (dB)",
    "modCod": "modCod",
    "modem": "modem",
    "CoverageBeamName": "beamInfo",
}


def signal_vs_coverage(
    device_metrics: DataFrame, devices: DataFrame, history: DataFrame, beam_map: DataFrame, coverage: DataFrame,
    cell: float, zone: str = "UTC",
) -> DataFrame:
    """Device samples with the beam and SNR known at their time and the coverage polygon around them.

    ``device_metrics`` has ``time`` (timestamp) and the sample columns, ``history`` the tidy metric
    history with ``timestamp``. Samples without a beam in the last 100 days, an SNR in the last day
    or a polygon of that beam around them are left out.
    """
    samples = device_metrics.select(
        "time", "ASMSerial", "longitude", "latitude", "pl-esno", "rx-theta", "antenna-frequency-rx"
    )
    modems = devices.select(
        F.col("AsmSerial").alias("ASMSerial"), F.col("ModemSerial").try_cast("int").alias("ModemSerial")
    ).dropna()
    located = samples.join(modems, "ASMSerial").dropna()

    modem = F.col("ModemSerial").try_cast("int").alias("ModemSerial")
    beams = (
        history.filter(F.col("MetricInt") == BEAM_METRIC)
        .select(F.col("timestamp").alias("beam_time"), modem, F.col("Data").cast("int").alias("BeamID"))
        .join(beam_map.withColumn("BeamID", F.col("BeamID").try_cast("int")), "BeamID")
        .drop("BeamID")
        .dropna()
    )
    snr = history.filter(F.col("MetricInt") == SNR_METRIC).select(
        F.col("timestamp").alias("snr_time"), modem, F.col("Data").alias("SNR")
    )
    lookups = [
        Lookup(beams, "beam_time", BEAM_WITHIN, ["PulseBeamName"]),
        Lookup(snr, "snr_time", SNR_WITHIN, ["SNR"]),
    ]
    measured = asof_join_all(located, lookups, ["ModemSerial"], "time").drop("beam_time", "snr_time").dropna()

    covered = spatial_join(
        measured, coverage, "longitude", "latitude", "polygon", cell, on=[("FWD", "CoverageBeamName")]
    )
    return covered.select(
        to_utc(F.col("time"), zone).alias("time"),
        "ASMSerial",
        F.col("latitude").alias("Latitude"),
        F.col("longitude").alias("Longitude"),
        "ModemSerial",
        "PulseBeamName",
        "CoverageBeamName",
        F.col("pl-esno").alias("pl-esno (ASMMetrics)"),
        F.col("SNR").alias("SNR (Pulse)"),
        F.col("fwd_cn").try_cast("double").alias("C/N (coverage)"),
        F.col("rx-theta").alias("rx-theta (ASMMetrics)"),
        F.col("antenna-frequency-rx").alias("antenna-frequency-rx (ASMMetrics)"),
    )
