"""trolley -- basket-behaviour analytics on Spark.

Entry points:
  * ``trolley.plans.warehouse.Warehouse`` -- ``get(spark, driver_dir)`` or ``from_files(spark, dir)``;
    raw tables, staging views and marts as DataFrames.
  * ``trolley.catalog.registry()`` -- every query key -> callable(spark, sf_dir); ``.on(warehouse)``.
  * ``python -m trolley build|query|list`` -- the command line.
"""
