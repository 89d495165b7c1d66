"""Column expressions (JVM-side, codegen-friendly) shared by the operators."""

from roundstats.functions.columns import (
    JAVA_NUMBER_SPELLINGS,
    distance,
    java_length,
    java_split,
    nearest_center,
    number_token_ok,
    salt,
    uniform,
    whitespace_tokens,
)

__all__ = [
    "JAVA_NUMBER_SPELLINGS",
    "distance",
    "java_length",
    "java_split",
    "nearest_center",
    "number_token_ok",
    "salt",
    "uniform",
    "whitespace_tokens",
]
