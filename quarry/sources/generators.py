"""A5: row generator re-aimed. ``generate_series(1, n)`` becomes per-row
expressions over the ids of a driving table, so the output grows with it and
every value is repeatable (the random price is a fixed integer formula of the
id, not ``rand()``, whose value depends on partitioning)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: status words and, in the formulas below, the moduli, start time
# and price range that the generated rows must have
STATUS_CANCELLED, STATUS_BOOKED, STATUS_DONE = "CANCELADA", "AGENDADA", "REALIZADA"


def visits_from_ids(ids: DataFrame, g: str) -> DataFrame:
    """Clinic visits from the generator formulas of the tuning lesson."""
    gc = F.col(g)
    start = F.lit("2024-01-01 08:00:00").cast("timestamp_ntz")
    ts = (start + F.make_dt_interval((gc % 730).cast("int"), F.lit(0), F.lit(0))
          + F.make_dt_interval(F.lit(0), (gc % 10).cast("int"), F.lit(0)))
    status = (F.when(gc % 20 == 0, STATUS_CANCELLED).when(gc % 20 == 1, STATUS_BOOKED)
              .otherwise(STATUS_DONE))
    # price in [80.00, 500.00]: a repeatable spread of the id in cents
    price = (F.lit(8000) + (gc * 7919) % 42001).cast("decimal(18,0)") / 100
    return ids.select(
        gc.alias("consulta_id"),
        (gc % 50000 + 1).alias("paciente_id"),
        (gc % 200 + 1).alias("medico_id"),
        (gc % 3 + 1).alias("convenio_id"),
        ts.alias("data_hora"),
        status.alias("status"),
        price.cast("decimal(10,2)").alias("valor"),
        F.concat(F.lit("CRM-"), F.lpad((gc % 200 + 1).cast("string"), 6, "0")).alias("crm"))
