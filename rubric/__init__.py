"""rubric: model-evaluation analytics expressed as Spark DataFrame plans.

Datasets, model responses and judge verdicts are tables; every metric,
judge rule and roll-up is a lazy DataFrame transformation that Catalyst
plans and Spark executes in parallel.
"""

__version__ = "0.1.0"
