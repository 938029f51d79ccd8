"""Session settings."""

from orderloom.session import SCALE_DEFAULTS, apply_scale_defaults


def test_methods_too_large_to_compile_are_not_generated(spark):
    fresh = spark.newSession()
    fresh.conf.unset("spark.sql.codegen.hugeMethodLimit")
    assert SCALE_DEFAULTS["spark.sql.codegen.hugeMethodLimit"] == "8000"
    assert apply_scale_defaults(fresh).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
