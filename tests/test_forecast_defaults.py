import inspect

import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightloom.operators import boosting as bo, forecast_models as fm


def test_defaults_are_the_whole_model(spark):
    """Registered forecasts pass no settings, so these hold for them."""
    of = lambda fn: {k: p.default for k, p in inspect.signature(fn).parameters.items()}
    assert (of(bo.fit_gbt)["trees"], of(bo.fit_gbt)["depth"], of(bo.forecast_gbt)["horizon"]) == (1000, 6, 90)
    assert (of(fm.fit_ensemble)["trees"], of(fm.fit_ensemble)["depth"]) == (1000, 6)
    days = pd.date_range("2023-01-01", periods=120).date
    df = spark.createDataFrame([("s", d, float(10 + i % 7)) for i, d in enumerate(days)], "series_id string, ds date, y double")
    models = bo.fit_gbt(df)
    assert models.select("trees", F.size("feature")).first()[:] == (1000, 1000 * 127)
    made = bo.forecast_gbt(models).orderBy("ds").toPandas()
    assert len(made) == 90 and made["yhat"].tolist() == pytest.approx([10 + (120 + i) % 7 for i in range(90)], abs=0.5)
