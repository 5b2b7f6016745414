"""Column rules. Where a rule needs an intermediate value several times it is a `with_`
function on a DataFrame: Spark evaluates a column of a lower projection once, but a
repeated expression inside CASE branches again and again.
"""

from pyspark.sql import Column, DataFrame


def add_layers(df: DataFrame, *layers: dict[str, Column]) -> DataFrame:
    """Add columns layer by layer; helpers named '__' of all but the last are dropped."""
    for layer in layers:
        df = df.withColumns(layer)
    return df.drop(*[name for layer in layers[:-1] for name in layer if name.startswith("__")])
