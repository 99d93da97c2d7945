"""Input schemas, rename dictionary and metric dictionary."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: device-metrics JSON -------------------------------------
# Numbers that arrive in quotes, and the column each becomes at rest.
QUOTED_METRICS = {
    "+1.1V_D (V)": "+1_1V_D",
    "+1.5V_D (V)": "+1_5V_D",
    "+2.5V_D (V)": "+2_5V_D",
    "+3.3V_D (V)": "+3_3V_D",
    "+5V (V)": "+5V_D",
    "-20V (V)": "-20V_D",
    "Analog voltage (V)": "Analog_voltage__V",
    "Board input current (A)": "Board_input_current__A",
    "Board input voltage (V)": "Board_input_voltage__V",
    "Clock voltage (V)": "Clock_voltage__V",
    "Gate Current (A)": "Gate_Current__A",
    "Gate Voltage (V)": "Gate_Voltage__V",
    "Heater Control (V)": "Heater_Control__V",
    "Quadrant 1 Thermistor (C)": "Quadrant_1_Thermistor__C",
    "Quadrant 2 Thermistor (C)": "Quadrant_2_Thermistor__C",
    "Quadrant 3 Thermistor (C)": "Quadrant_3_Thermistor__C",
    "Quadrant 4 Thermistor (C)": "Quadrant_4_Thermistor__C",
    "Relative Humidity (%)": "Relative_Humidity__Percent",
    "Source current (A)": "Source_current__A",
    "Source voltage (V)": "Source_voltage__V",
    "Temperature (C)": "Temperature__C",
}
LONG_METRICS = (
    "agc antenna-frequency-rx antenna-frequency-tx gps_fix gps_fix_quality pl-sync timestamp-S"
).split()
TEXT_METRICS = (
    "antenna-polarization-type-rx antenna-polarization-type-tx antenna-type mode target-type"
).split()
FLAG_METRICS = ["rx-lock"]
DOUBLE_METRICS = (
    "altitude direction latitude longitude pl-esno r-esno rx-lpa rx-phi rx-theta speed "
    "target-altitude target-latitude target-longitude target-polarization-rx "
    "target-polarization-tx target-symbol-rate-msyms tx-lpa tx-phi tx-theta"
).split()

# --- fixed values: metric dictionary (column at rest -> report code) --------
METRIC_CODES = {
    "+1_1V_D": "ASM-SENSOR-1.1V",
    "+1_5V_D": "ASM-SENSOR-1.5V",
    "+2_5V_D": "ASM-SENSOR-2.5V",
    "+3_3V_D": "ASM-SENSOR-3.3V",
    "+5V_D": "ASM-SENSOR-5V",
    "-20V_D": "ASM-SENSOR-20V",
    "Quadrant_1_Thermistor__C": "ASM-THERMISTOR-Q1",
    "Quadrant_2_Thermistor__C": "ASM-THERMISTOR-Q2",
    "Quadrant_3_Thermistor__C": "ASM-THERMISTOR-Q3",
    "Quadrant_4_Thermistor__C": "ASM-THERMISTOR-Q4",
    "Analog_voltage__V": "ASM-SENSOR-ANALOG-VOLTAGE",
    "Board_input_current__A": "ASM-BOARD-INPUT-CURRENT",
    "Board_input_voltage__V": "ASM-BOARD-INPUT-VOLTAGE",
    "Clock_voltage__V": "ASM-CLOCK-VOLTAGE",
    "Gate_Current__A": "ASM-GATE-CURRENT",
    "Gate_Voltage__V": "ASM-GATE-VOLTAGE",
    "Heater_Control__V": "ASM-HEATER-CONTROL-VOLTAGE",
    "Relative_Humidity__Percent": "ASM-HUMIDITY-RELATIVE",
    "Source_current__A": "ASM-SOURCE-CURRENT",
    "Source_voltage__V": "ASM-SOURCE-VOLTAGE",
    "Temperature__C": "ASM-TEMPERATURE",
    "altitude": "ASM-ALTITUDE",
    "direction": "ASM-DIRECTION",
    "latitude": "ASM-LATITUDE",
    "longitude": "ASM-LONGITUDE",
    "rx-lpa": "ASM-RX-LPA",
    "rx-phi": "ASM-RX-PHI",
    "rx-theta": "ASM-RX-THETA",
    "tx-lpa": "ASM-TX-LPA",
    "tx-phi": "ASM-TX-PHI",
    "tx-theta": "ASM-TX-THETA",
    "speed": "ASM-SPEED",
    "target-longitude": "ASM-TARGET-LONGITUDE",
    "target-symbol-rate-msyms": "ASM-TARGET-SYMBOL-RATE-MSYMS",
    "pl-esno": "ASM-PL-ESNO",
}

# --- fixed values: usage and signal metric numbers, management-traffic mark --
UPLOAD_METRIC, DOWNLOAD_METRIC = 1054, 1055
BEAM_METRIC, SNR_METRIC = 1698, 1098
MANAGEMENT_TRAFFIC = "NMS_SSPP"
#: Reversed row keys are this number minus the epoch second.
MAX_TICKS = 3155378975999999999

# --- fixed values: report vocabularies --------------------------------------
TICKET_STATUSES = ["open", "pending", "waiting_on_3rd_party", "waiting_on_customer", "resolved", "closed"]
TICKET_PRIORITIES = ["high", "low", "normal", "urgent"]


def _fields(names, data_type):
    return [T.StructField(name, data_type) for name in names]


def device_metrics() -> T.StructType:
    """Raw device-metrics objects: one per line, quoted numbers still text."""
    return T.StructType(
        _fields(QUOTED_METRICS, T.StringType())
        + _fields(LONG_METRICS, T.LongType())
        + _fields(TEXT_METRICS, T.StringType())
        + _fields(FLAG_METRICS, T.BooleanType())
        + _fields(DOUBLE_METRICS, T.DoubleType())
    )


_SUITE = "failures: bigint, name: string, `start-time`: string, `stop-time`: string, tests: bigint, time: double"
_CASE = (
    "classname: string, data: struct<message: string, status: bigint, values: array<double>>, "
    "message: string, name: string, status: bigint, time: double"
)
_SELF_TEST = (
    "`antenna-serial-number` string, `asm-serial-number` string, customer string, "
    "`serial-number` string, status bigint, testsuites array<struct<{suite}>>"
)
#: Self-test documents without the inner test detail, which is then never parsed.
SELF_TEST = _SELF_TEST.format(suite=_SUITE)
#: The same documents with every nested test case.
SELF_TEST_FULL = _SELF_TEST.format(
    suite=_SUITE
    + ", testsuite: array<struct<failures: bigint, name: string, status: bigint, "
    + f"testcase: array<struct<{_CASE}>>, tests: bigint, time: double>>"
)

_BEAM_SETUP = (
    "struct<pattern_type: string, config_to_use: string, web_api_parameters: string, settling_time: double, "
    "pattern_config_file: string, stop_frequency: double, freq_step_ghz: double, start_frequency: double, "
    "PPF_file: string, wave_equation_parameters: struct<binary: string, bin_threshold: string, phi: double, "
    "index_of_refraction: string, lin_pol_angle: double, phase: string, theta: double, freq: double, "
    "mod_power: string>>"
)
_CHAMBER_TEXT = (
    "jira start_time band measurement_type test_chamber hertzscan_version auxiliary_angle "
    "testplan asm_firmware_version comments data_in_file stop_time File"
).split()
CHAMBER = (
    ", ".join(f"{name} string" for name in _CHAMBER_TEXT)
    + f", Date date, Tx {_BEAM_SETUP}, Rx {_BEAM_SETUP}, "
    + "orbit_sw_version struct<build_state: string, module_version: string, build_number: string, "
    + "server_version: string, product_version: string>, "
    + "axis_mapping struct<Auxiliary: string, Primary: string, Tertiary: string, Secondary: string>, "
    + "antenna_datafile_pairs struct<Rx: string>, "
    + "data array<struct<Point: int, Tertiary: double, Secondary: double, Frequency: double, "
    + "Primary: double, Ch1_dB: double, Ch1_Deg: double>>"
)

#: JSON text held in the check-in table's ``ActivePartition`` column.
ACTIVE_PARTITION = (
    "Uuid string, Type string, Device string, Label string, FsType string, "
    "Size bigint, Used bigint, MountPath string, SoftwareVersion string"
)

#: A GeoJSON feature collection; rings are ``[lon, lat]`` pairs.
GEOJSON = (
    "features array<struct<geometry: struct<type: string, coordinates: array<array<array<double>>>>, "
    "properties: map<string, string>>>"
)

# --- fixed values: source tables copied as snapshots (identifiers become text) ---
SNAPSHOTS = {
    "tickets": (
        "Id string, CreatedOn timestamp, CreatedById string, ModifiedOn timestamp, ModifiedById string, "
        "Subject string, Description string, Status string, Substatus string, Type string, Source string, "
        "Priority string, AssignedToId string, AccountId string, Number int, IsAlert boolean, Test boolean, "
        "ClosedOn timestamp"
    ),
    "tags": (
        "Id string, EntityId string, EntityType string, CreatedOn timestamp, CreatedById string, Name string, "
        "Description string"
    ),
    "subscriptions": (
        "Id string, CreatedOn timestamp, CreatedById string, ModifiedOn timestamp, ModifiedById string, "
        "RemoteId string, StartDate timestamp, EndDate timestamp, RequestedCommissionDate timestamp, Active boolean, "
        "SubscriptionNumber string, Limit int, NetworkId string, ServicePlanId string, DataPackageId string, "
        "ActivityTypeId string, RegionId string, AutoRenew boolean, DurationInMonths int"
    ),
}


def snapshot_columns(name: str) -> dict[str, str]:
    """Column types of a snapshot table by column name."""
    return dict(column.split(" ") for column in SNAPSHOTS[name].split(", "))
