"""Plain-Python answers and small tables for the tests."""


def starts(text: bytes, pattern: bytes) -> list[int]:
    """Every start of ``pattern`` in ``text``, overlapping ones included."""
    if not pattern:
        return []
    return [i for i in range(len(text) - len(pattern) + 1) if text[i : i + len(pattern)] == pattern]


def brute(texts: dict, patterns: dict) -> list[tuple]:
    return sorted(
        (t, p, i) for t, body in texts.items() for p, pat in patterns.items() for i in starts(body, pat)
    )


def text_table(spark, texts: dict):
    return spark.createDataFrame(
        [(k, bytearray(v)) for k, v in texts.items()], "text_id BIGINT, body BINARY"
    )


def pattern_table(spark, patterns: dict):
    return spark.createDataFrame(
        [(k, bytearray(v)) for k, v in patterns.items()], "pattern_id INT, pattern BINARY"
    )


def rows(df, *names) -> list[tuple]:
    names = names or ("text_id", "pattern_id", "byte_pos")
    return sorted(tuple(r[n] for n in names) for r in df.select(*names).collect())
