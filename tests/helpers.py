"""Helpers that the report tests import."""

import datetime as dt
import decimal


def _value(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def rows(df):
    """Rows as plain tuples in a stable order."""
    return sorted((tuple(_value(v) for v in r) for r in df.collect()), key=repr)


def dicts(df):
    """Rows as dicts in result order."""
    return [{k: _value(v) for k, v in r.asDict().items()} for r in df.collect()]


def stamp(text):
    return dt.datetime.fromisoformat(text)


def day(text):
    return dt.date.fromisoformat(text)


def frame(spark, schema, records):
    """A frame of dicts; missing columns are NULL, numbers become decimals where the schema says so."""
    out = []
    for r in records:
        unknown = set(r) - set(schema.names)
        assert not unknown, unknown
        values = []
        for f in schema.fields:
            v = r.get(f.name)
            if v is not None and f.dataType.typeName() == "decimal":
                v = decimal.Decimal(str(v))
            elif isinstance(v, str) and f.dataType.typeName() == "timestamp":
                v = stamp(v)
            elif isinstance(v, str) and f.dataType.typeName() == "date":
                v = day(v)
            values.append(v)
        out.append(tuple(values))
    return spark.createDataFrame(out, schema)
