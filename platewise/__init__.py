"""platewise: a Spark-native nutrition-intake warehouse.

Raw food documents and nested daily meal logs become a star schema (staged
data, per-food nutrient profiles, scaled and daily intake, BMI history,
threshold segments by day and over trailing windows) with incremental and
SCD2 writes, data-quality checks and reporting queries. Every step is a
DataFrame function; see ``platewise.plans.build.Warehouse`` for the wiring.
"""

__version__ = "0.1.0"
