"""meterwise: daily customer revenue / usage analytics as Spark jobs.

Everything is a pure ``DataFrame -> DataFrame`` function so Catalyst sees
one logical plan per output; state lives in catalog tables
(``meterwise.plans.tables``) and is only touched by ``meterwise.plans.daily``.
"""

__version__ = "0.1.0"
