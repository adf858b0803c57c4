"""strata: data-modelling operators (cumulative snapshots, SCD2, property
graphs, fact tables, activity bitmaps, month metric arrays) on Spark SQL."""

__version__ = "0.1.0"
