"""The scalar functions for SQL users: temporary SQL functions with a text of their own, which the optimizer inlines.

They say what the column functions of this package say, so a query in SQL and one on DataFrames have the same plan, without
Python. Names carry a prefix, so they hide no other function.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

PREFIX = "sl_"

#: Name, parameters, type of the result, text. ``{p}`` stands for the prefix.
FUNCTIONS: list[tuple[str, str, str, str]] = [
    ("make_fid", "slot INT, signature BIGINT", "BIGINT", "shiftleft(CAST(slot AS BIGINT), 48) | (signature & 281474976710655)"),
    ("make_fid_v1", "slot INT, signature BIGINT", "BIGINT", "shiftleft(CAST(slot AS BIGINT), 54) | (signature & 18014398509481983)"),
    ("slot_of", "fid BIGINT", "INT", "CAST(shiftrightunsigned(fid, 48) & 32767 AS INT)"),
    ("slot_of_v1", "fid BIGINT", "INT", "CAST(shiftrightunsigned(fid, 54) & 1023 AS INT)"),
    ("signature_of", "fid BIGINT", "BIGINT", "fid & 281474976710655"),
    ("v1_to_v2", "fid BIGINT", "BIGINT", "{p}make_fid({p}slot_of_v1(fid), fid)"),
    ("switch_slot", "fids ARRAY<BIGINT>, slot INT", "ARRAY<BIGINT>", "transform(fids, f -> shiftleft(CAST(slot AS BIGINT), 48) | (f & 281474976710655))"),
    ("extract_fid", "value BIGINT, slot INT", "BIGINT", "{p}make_fid(slot, xxhash64(value))"),
    ("feature_hash", "value STRING, name STRING, slot INT", "BIGINT", "{p}make_fid(slot, xxhash64(concat(value, '-', name)))"),
    ("float_bucket", "x DOUBLE", "BIGINT", "CAST(floor(log2(abs(x) + 1.0D)) AS BIGINT)"),
    ("fid_mask", "fids ARRAY<BIGINT>, fid BIGINT", "DOUBLE", "CAST(coalesce(array_contains(fids, fid), false) AS DOUBLE)"),
    ("seq_mask", "size INT, max_len INT", "ARRAY<INT>", "transform(sequence(0, max_len - 1), i -> CASE WHEN i < size THEN 1 ELSE 0 END)"),
    ("safe_log_sigmoid", "x DOUBLE", "DOUBLE", "-(greatest(x, 0.0D) - x + log1p(exp(-abs(x))))"),
    ("sigmoid", "x DOUBLE", "DOUBLE", "CASE WHEN x >= 0 THEN 1.0D / (1.0D + exp(-abs(x))) ELSE exp(-abs(x)) / (1.0D + exp(-abs(x))) END"),
    ("logit_correction", "logit DOUBLE, sample_rate DOUBLE", "DOUBLE", "logit - ln(sample_rate)"),
    ("polynomial_decay", "step BIGINT, initial DOUBLE, decay_steps INT, last DOUBLE, power DOUBLE", "DOUBLE",
     "(initial - last) * pow(1.0D - least(CAST(step AS DOUBLE), CAST(decay_steps AS DOUBLE)) / CAST(decay_steps AS DOUBLE), power) + last"),
    ("any_action", "actions ARRAY<INT>, wanted ARRAY<INT>", "BOOLEAN", "coalesce(arrays_overlap(actions, wanted), false)"),
    ("map_id", "x BIGINT, mapping MAP<BIGINT, BIGINT>", "BIGINT", "coalesce(try_element_at(mapping, x), -1L)"),
    ("has_slots", "fids ARRAY<BIGINT>, slots ARRAY<INT>", "BOOLEAN",
     "size(array_except(slots, transform(fids, f -> CAST(shiftrightunsigned(f, 48) & 32767 AS INT)))) = 0"),
    ("by_label", "label ARRAY<DOUBLE>, thresholds ARRAY<DOUBLE>", "BOOLEAN",
     "coalesce(size(label) >= size(thresholds) AND exists(zip_with(slice(label, 1, size(thresholds)), thresholds, (x, t) -> x >= t), h -> h), false)"),
    ("label_upper_bound", "label ARRAY<DOUBLE>, bounds ARRAY<DOUBLE>", "ARRAY<DOUBLE>",
     "CASE WHEN size(label) < size(bounds) THEN label ELSE concat(zip_with(slice(label, 1, size(bounds)), bounds, (x, b) -> least(x, b)), "
     "slice(label, size(bounds) + 1, size(label))) END"),
    ("field_as_label", "field DOUBLE, threshold DOUBLE, overwrite DOUBLE", "ARRAY<DOUBLE>",
     "array(CASE WHEN field >= threshold THEN overwrite ELSE field END)"),
    ("real_weight", "is_positive BOOLEAN, real_negative DOUBLE", "DOUBLE",
     "CASE WHEN is_positive THEN 1.0D WHEN real_negative > 0.00001D THEN real_negative ELSE 1.0D END"),
]


def register(spark: SparkSession, prefix: str = PREFIX) -> list[str]:
    """Makes the functions in the session; returns their names."""
    for name, params, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({params}) RETURNS {kind} RETURN {body.format(p=prefix)}")
    return [prefix + f[0] for f in FUNCTIONS]


def register_request(spark: SparkSession, instance: str, prefix: str = PREFIX) -> str:
    """Makes the table function that gives a request's instances, for instances with the fields ``instance`` (as in a table
    definition): ``SELECT … FROM requests, LATERAL sl_explode_request(instances)``."""
    fields = ", ".join(f"{f.split()[0]}: {' '.join(f.split()[1:])}" for f in instance.split(", "))
    names = ", ".join(f"i.{f.split()[0]}" for f in instance.split(", "))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}explode_request(instances ARRAY<STRUCT<{fields}>>) RETURNS TABLE (pos INT, {instance}) "
              f"RETURN SELECT pos, {names} FROM posexplode(instances) AS t(pos, i)")
    return f"{prefix}explode_request"
