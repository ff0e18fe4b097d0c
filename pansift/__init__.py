"""pansift: Spark-native operators for building, cleaning and profiling
entity x date panels.

Every operator is a plain function ``f(df, ...) -> DataFrame`` built from
DataFrame / Spark SQL expressions, so plans stay lazy and Catalyst does the
pushdown, pruning and join planning.  Fitted statistics (means, quantiles,
bounds) are computed with one aggregate and applied as literals, the same
fit/transform split Spark ML estimators use.
"""

__version__ = "0.1.0"
