import os
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("ratewise-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


AIRPORTS = ["EZE", "AEP", "BOG", "MDE", "GRU", "PTY"]


def flight_frame(n=600, seed=7):
    """Flights with every awkward case the operators must handle."""
    rng = np.random.default_rng(seed)
    origin = rng.choice(AIRPORTS, n, p=[0.34, 0.1, 0.16, 0.15, 0.15, 0.1])
    destination = np.array([rng.choice([a for a in AIRPORTS if a != o]) for o in origin])
    f = pd.DataFrame(
        {
            "id_vuelo": np.arange(1, n + 1),
            "aeropuerto_origen": origin,
            "aeropuerto_destino": destination,
            "hora_salida_programada": [f"{h:02d}:{m:02d}" for h, m in zip(rng.integers(0, 24, n), rng.choice([0, 15, 30, 45], n))],
            "dia_semana": rng.choice(["lunes", "martes", "sabado"], n),
            "distancia_vuelo": rng.gamma(4.0, 300.0, n).round(1),
            "ocupacion_vuelo": rng.uniform(5, 100, n).round(2),
            "visibilidad": rng.exponential(3000.0, n).round(1),
            "condiciones_climaticas": rng.choice(["Despejado", "Nublado", "Lluvia"], n, p=[0.5, 0.3, 0.2]),
            "congestion_aerea": rng.choice(["Alta", "Media", "Baja"], n),
            "tipo_avion": rng.choice(["A320", "B737", "E190"], n),
            "temporada_alta": rng.random(n) < 0.3,
            "constante": 5.0,
            "demora": (rng.random(n) < 0.32).astype("int64"),
        }
    )
    f["tiempo_estimado_vuelo"] = (f["distancia_vuelo"] / 12 + rng.normal(0, 5, n)).clip(20).round(0)
    f.loc[3, "aeropuerto_destino"] = f.loc[3, "aeropuerto_origen"]
    f.loc[4, ["aeropuerto_origen", "aeropuerto_destino"]] = ["EZE", "AEP"]
    f.loc[5, ["aeropuerto_origen", "aeropuerto_destino"]] = ["AEP", "EZE"]
    f.loc[6, "tiempo_estimado_vuelo"] = 0.0
    f.loc[7, "tiempo_estimado_vuelo"] = np.nan
    f.loc[8, "ocupacion_vuelo"] = -1.0
    f.loc[9, "ocupacion_vuelo"] = 0.0
    f.loc[10, "ocupacion_vuelo"] = 104.5
    f.loc[11:40, "visibilidad"] = np.nan
    f.loc[41:60, "condiciones_climaticas"] = None
    f.loc[61, "hora_salida_programada"] = "7"
    f.loc[62, "hora_salida_programada"] = "14:35:00"
    f.loc[63, "hora_salida_programada"] = "24:10"
    f.loc[64, "hora_salida_programada"] = ""
    f.loc[65, "hora_salida_programada"] = None
    f.loc[66, "tiempo_estimado_vuelo"] = 2000.0
    same = f.columns.drop("id_vuelo")
    f.loc[70, same] = f.loc[71, same]
    f.loc[72, same] = f.loc[71, same]
    return f


@pytest.fixture(scope="session")
def flights_pd():
    return flight_frame()


@pytest.fixture(scope="session")
def flights(spark, flights_pd):
    return to_spark(spark, flights_pd, 3)


def to_spark(spark, pdf, partitions=3):
    """pandas to Spark with NaN and None as nulls."""
    kinds = {"i": "long", "f": "double", "b": "boolean", "O": "string"}
    schema = ", ".join(f"`{c}` {kinds[pdf[c].dtype.kind]}" for c in pdf.columns)
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in pdf.astype(object).itertuples(index=False)]
    return spark.createDataFrame(rows, schema).repartition(partitions)
