"""Fixed table schemas. Readers apply these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# In precedence order: the last list that names a test decides its status.
STATUS_BY_FIELD = {
    "passed_tests": "PASSED",
    "failed_tests": "FAILED",
    "skipped_tests": "SKIPPED",
    "errored_tests": "ERROR",
}
STATUS_FIELDS = list(STATUS_BY_FIELD)
OUTCOME_FIELDS = [*STATUS_FIELDS, "discovery_errors"]

# Report merging keeps the most severe status.
SEVERITY = {"PASSED": 0, "SKIPPED": 1, "FAILED": 2, "ERROR": 3}

# Keys of the metadata object.
BASE_ID_PATH = "$.base_id"
GROUP_ID_PATH = "$.swefficiency.instance_id"
GROUP_VARIANT_PATH = "$.swefficiency.variant"

_strings = T.ArrayType(T.StringType())


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


STATES = _struct(
    instance_id=T.StringType(),
    repo=T.StringType(),
    base_commit=T.StringType(),
    patch=T.StringType(),
    container=T.StringType(),
    command=T.StringType(),
    command_workload=T.StringType(),
    command_workload_amplified=T.StringType(),
    test_scope=_strings,
    metadata=T.StringType(),
    passed_tests=_strings,
    failed_tests=_strings,
    skipped_tests=_strings,
    errored_tests=_strings,
    discovery_errors=_strings,
    execution_data=T.StringType(),
)

PAIRS = _struct(
    pair_id=T.StringType(),
    repo=T.StringType(),
    base_commit=T.StringType(),
    container=T.StringType(),
    command=T.StringType(),
    is_base_healthy=T.BooleanType(),
    instance_id_A=T.StringType(),
    instance_id_B=T.StringType(),
    patch_A=T.StringType(),
    patch_B=T.StringType(),
    **{f"{field}_{side}": _strings for field in OUTCOME_FIELDS for side in ("A", "B")},
    metadata_A=T.StringType(),
    metadata_B=T.StringType(),
    is_clone=T.BooleanType(),
    num_flipped_tests=T.LongType(),
    flipped_ratio=T.DoubleType(),
    pair_metadata=T.StringType(),
)

OUTCOMES = _struct(instance_id=T.StringType(), test=T.StringType(), status=T.StringType())

FUNCTION_RECORD = _struct(
    func=T.StringType(),
    file=T.StringType(),
    lineno=T.IntegerType(),
    call_count=T.LongType(),
    total_time_s=T.DoubleType(),
    exclusive_time_s=T.DoubleType(),
    exclusive_alloc_bytes=T.LongType(),
    exclusive_rss_bytes=T.LongType(),
)

LINE_RECORD = _struct(
    hits=T.LongType(), time_ns=T.LongType(), alloc_bytes=T.LongType(), rss_bytes=T.LongType()
)

CALL_RECORD = _struct(func=T.StringType(), file=T.StringType(), lineno=T.IntegerType(), depth=T.IntegerType())

TRACE_TEST = _struct(
    outcome=T.StringType(),
    outcome_details=_struct(
        is_assertion=T.BooleanType(), failure_line=T.IntegerType(), exception_type=T.StringType()
    ),
    wall_time_s=T.DoubleType(),
    setup_time_s=T.DoubleType(),
    call_time_s=T.DoubleType(),
    teardown_time_s=T.DoubleType(),
    start_rss_bytes=T.LongType(),
    peak_rss_bytes=T.LongType(),
    start_traced_bytes=T.LongType(),
    peak_traced_bytes=T.LongType(),
    tracemalloc_enabled=T.BooleanType(),
    trimmed=T.BooleanType(),
    trim_info=T.ArrayType(_struct(reason=T.StringType())),
    functions=T.ArrayType(FUNCTION_RECORD),
    lines=T.MapType(T.StringType(), T.MapType(T.StringType(), LINE_RECORD)),
    call_sequence=T.ArrayType(CALL_RECORD),
)

TRACE_DOCUMENT = _struct(
    instance_id=T.StringType(),
    tracer_version=T.StringType(),
    trace_level=T.StringType(),
    memory_tracking=T.StringType(),
    backend=T.StringType(),
    python_version=T.StringType(),
    test_count=T.IntegerType(),
    tests=T.MapType(T.StringType(), TRACE_TEST),
)

PROFILE_FUNCTION = _struct(
    filename=T.StringType(),
    firstlineno=T.IntegerType(),
    qualname=T.StringType(),
    call_count=T.LongType(),
    exclusive_time_s=T.DoubleType(),
    inclusive_time_s=T.DoubleType(),
)

PROFILE_DOCUMENT = _struct(
    tests=T.MapType(
        T.StringType(),
        _struct(
            outcome=T.StringType(),
            wall_time_s=T.DoubleType(),
            profile_time_s=T.DoubleType(),
            functions=T.MapType(T.StringType(), PROFILE_FUNCTION),
        ),
    )
)

CASE_REPORT = T.MapType(
    T.StringType(),
    T.MapType(
        T.StringType(),
        _struct(
            passed=T.ArrayType(T.BooleanType()),
            failed=T.ArrayType(T.BooleanType()),
            runtime_errors=T.ArrayType(T.BooleanType()),
            timeouts=T.ArrayType(T.BooleanType()),
            memory_limit_exceeded=T.ArrayType(T.BooleanType()),
        ),
    ),
)

_xml_child = _struct(_message=T.StringType(), _VALUE=T.StringType())
TESTCASE_XML = _struct(
    _file=T.StringType(),
    _classname=T.StringType(),
    _name=T.StringType(),
    failure=_xml_child,
    error=_xml_child,
    skipped=_xml_child,
)

PREDICTIONS = _struct(
    instance_id=T.StringType(),
    model_name_or_path=T.StringType(),
    model_patch=T.StringType(),
    status=T.StringType(),
    trajectory_length=T.IntegerType(),
)

EVAL_REPORT_NUMBERS = [
    "human_speedup_ratio",
    "raw_pred_speedup_ratio",
    "correctness_pct",
    "gold_speedup_ratio",
    "pre_edit_runtime",
]

SAMPLES = _struct(
    sample_id=T.StringType(),
    task=T.StringType(),
    instance_id=T.StringType(),
    test_nodeid=T.StringType(),
    repo=T.StringType(),
    base_commit=T.StringType(),
    side=T.StringType(),
    system_prompt=T.StringType(),
    user_prompt=T.StringType(),
    ground_truth=T.StringType(),
    metric=T.StringType(),
    metric_args=T.StringType(),
    metadata=T.StringType(),
)

RESPONSES = _struct(
    model=T.StringType(),
    sample_id=T.StringType(),
    task=T.StringType(),
    instance_id=T.StringType(),
    test_nodeid=T.StringType(),
    side=T.StringType(),
    raw_response=T.StringType(),
    error=T.StringType(),
)

FAILURES = _struct(
    instance_id=T.StringType(),
    category=T.StringType(),
    stage=T.StringType(),
    reason=T.StringType(),
    message=T.StringType(),
)
