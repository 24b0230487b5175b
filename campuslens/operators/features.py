"""Feature scenarios and encoding fitted on the training rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Predictor lists and the six information scenarios.
CATEGORICAL = ["asignatura", "escuela", "sexo", "zona", "tamano_familia", "estado_padres",
               "trabajo_madre", "trabajo_padre", "motivo_eleccion", "tutor_legal"]
FLAGS = ["apoyo_escolar", "apoyo_familiar", "actividades", "guarderia", "desea_superior",
         "internet", "relacion_romantica", "clases_pagadas"]
NUMERIC = ["edad", "educ_madre", "educ_padre", "tiempo_viaje", "tiempo_estudio",
           "relacion_familiar", "tiempo_libre", "salidas", "alcohol_semana", "alcohol_finde",
           "salud", "reprobaciones_previas"]
ACTIVITY_P1 = ["sim_lms_eventos_p1", "sim_lms_minutos_p1", "sim_lms_dias_activos_p1",
               "sim_lms_tareas_revisadas_p1"]


@dataclass(frozen=True)
class Scenario:
    name: str
    numeric: tuple
    flags: tuple

    def plus(self, name: str, *numeric: str) -> "Scenario":
        return Scenario(name, self.numeric + numeric, self.flags)

    @property
    def predictors(self) -> list[str]:
        return CATEGORICAL + list(self.numeric) + list(self.flags)


_C = Scenario("C_matricula", tuple(NUMERIC), tuple(FLAGS))
_A = Scenario("A_corte_P1", tuple(NUMERIC + ["nota_p1"]), tuple(FLAGS + ["no_evaluado_p1"]))
SCENARIOS = {s.name: s for s in (
    _C, _A,
    Scenario("B_corte_P2", tuple(NUMERIC + ["nota_p1", "nota_p2"]),
             tuple(FLAGS + ["no_evaluado_p1", "no_evaluado_p2"])),
    _A.plus("A_mas_sim", *ACTIVITY_P1), _A.plus("A_mas_faltas", "faltas"),
    _C.plus("C_mas_sim", *ACTIVITY_P1))}

#: Vector of the encoded categories in prepared rows.
CATEGORIES = "_categorias"


def union(scenarios: list[Scenario]) -> Scenario:
    """All predictors of several scenarios."""
    return Scenario("+".join(s.name for s in scenarios), tuple(dict.fromkeys(c for s in scenarios for c in s.numeric)),
                    tuple(dict.fromkeys(c for s in scenarios for c in s.flags)))


LEAKS = ["nota_p3", "no_evaluado_p3"]


def leaked(scenario: Scenario) -> list[str]:
    """L-01 and L-03: target columns and variables known only after the cut."""
    return [c for c in scenario.predictors
            if c in LEAKS or c.startswith("sim_n_") or c.endswith("_total")]


class Encoder:
    """Categories as 0/1 columns (two categories give one; unseen and missing ones give zeros), numbers and
    flags standardised by population deviation. All statistics come from the training rows; the
    categories are indexed and encoded as sparse vectors by Spark, so their number has no bound here."""

    def __init__(self, stages: list, levels: dict[str, list[str]], moments: dict[str, tuple[float, float]]):
        self.stages, self.levels, self.moments = stages, levels, moments

    @staticmethod
    def fit(train: DataFrame, scenario: Scenario, categories: list[str] = CATEGORICAL) -> "Encoder":
        index = StringIndexer(inputCols=categories, outputCols=[f"_index_{c}" for c in categories],
                              stringOrderType="alphabetAsc", handleInvalid="keep").fit(train)
        hot = OneHotEncoder(inputCols=index.getOutputCols(), outputCols=[f"_hot_{c}" for c in categories],
                            dropLast=True)  # the last index stands for unseen values
        levels = dict(zip(categories, map(list, index.labelsArray)))
        stages, encoded = [index, hot.fit(index.transform(train.limit(0)))], []
        for c in categories:
            if len(levels[c]) == 2:
                stages.append(VectorSlicer(inputCol=f"_hot_{c}", outputCol=f"_one_{c}", indices=[1]))
            encoded.append(f"_one_{c}" if len(levels[c]) == 2 else f"_hot_{c}")
        stages.append(VectorAssembler(inputCols=encoded, outputCol=CATEGORIES))
        scaled = list(scenario.numeric) + list(scenario.flags)
        row = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in scaled],
                        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in scaled]).first()
        return Encoder(stages, levels, {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in scaled})

    def names(self) -> list[str]:
        """Columns of the vector."""
        return [f"{c}={v}" for c, levels in self.levels.items()
                for v in (levels[1:] if len(levels) == 2 else levels)] + list(self.moments)

    def sources(self) -> list[str]:
        """The predictor behind each column of the vector."""
        return [c for c, levels in self.levels.items()
                for _ in (levels[1:] if len(levels) == 2 else levels)] + list(self.moments)

    def prepare(self, df: DataFrame) -> DataFrame:
        """``df`` with its encoded categories and standardised numbers, from which the vectors of all
        scenarios of these columns are put together."""
        out = df.withColumns({f"_scaled_{c}": (F.col(c).cast("double") - mean) / sd
                              for c, (mean, sd) in self.moments.items()})
        for stage in self.stages:
            out = stage.transform(out)
        return out.select(*df.columns, *self.parts(self.moments))

    @staticmethod
    def parts(scaled) -> list[str]:
        return [CATEGORIES, *[f"_scaled_{c}" for c in scaled]]

    def assemble(self, prepared: DataFrame, scaled) -> DataFrame:
        """Prepared rows with the vector ``features`` of the categories and the named columns."""
        return VectorAssembler(inputCols=self.parts(scaled), outputCol="features").transform(prepared)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the vector ``features``."""
        return self.assemble(self.prepare(df), self.moments).select(*df.columns, "features")
