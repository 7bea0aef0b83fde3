"""Rules on hand-made tickets: borders, nulls, odd texts, and the golden job rows."""

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from oncallmart import schema as S
from oncallmart.functions import calendar as C
from oncallmart.functions import numeric as N
from oncallmart.functions import tickets as X
from oncallmart.operators import analytics, silver, star
from oncallmart.plans import marts
from oncallmart.sources import bronze


def ticket(number="INC1", **changes):
    row = {
        "Numero": number, "Prioridade": "2 - Alta", "Produto": "P", "Categoria": "C",
        "Subcategoria": "S", "Grupo_designado": "Team01", "Item_de_configuracao": "CI",
        "Aberto": datetime(2025, 1, 6, 9), "Resolvido": datetime(2025, 1, 6, 10),
        "Encerrado": datetime(2025, 1, 6, 11), "Duracao": 7200,
        "Codigo_de_fechamento": "Sucesso", "Descricao_resumida": "d", "Solucao": "s",
        "Aberto_por": "u", "Incidente_Pai": None, "Status": "Encerrado",
        "Entrou_para_KPI": "SIM", "KPI_Violado": "NAO",
    }
    return {**row, **changes}


@pytest.fixture
def tickets(spark):
    nullable = S.BRONZE.__class__([f.__class__(f.name, f.dataType, True) for f in S.BRONZE])

    def make(*rows):
        return spark.createDataFrame([tuple(r[c] for c in S.BRONZE.names) for r in rows], nullable)

    return make


def values(frame, *columns):
    return [tuple(r) for r in frame.select(*columns).collect()]


@pytest.mark.parametrize(
    "text, number",
    [("1 - Crítica", 1), ("3 - Média", 3), (None, 5), ("", 5), ("Media", 5), ("6 - X", 6)],
)
def test_priority_number(spark, text, number):
    frame = spark.createDataFrame([(text,)], "p string")
    assert values(frame, X.priority_number(F.col("p"))) == [(number,)]


def test_unknown_status_counts_as_work(tickets):
    made = silver.silver(tickets(ticket(Status=None), ticket("INC2", Status=S.NOISE_STATUS)))
    assert sorted(values(made, "Numero", "Exige_Intervencao")) == [("INC1", 1), ("INC2", 0)]
    assert values(silver.real_work(made), "Numero") == [("INC1",)]


@pytest.mark.parametrize(
    "at, shift, off",
    [
        (datetime(2025, 1, 6, 7, 59, 59), "Manha", 1), (datetime(2025, 1, 6, 8), "Manha", 0),
        (datetime(2025, 1, 6, 18, 59, 59), "Noite", 0), (datetime(2025, 1, 6, 19), "Noite", 1),
        (datetime(2025, 1, 6, 0), "Madrugada", 1), (datetime(2025, 1, 6, 5, 59), "Madrugada", 1),
        (datetime(2025, 1, 6, 6), "Manha", 1), (datetime(2025, 1, 6, 12), "Tarde", 0),
    ],
)
def test_shift_and_off_hours_borders(spark, at, shift, off):
    frame = spark.createDataFrame([(at,)], "t timestamp_ntz")
    hour = F.hour("t")
    assert values(frame, C.shift(hour), C.off_hours(hour)) == [(shift, off)]


def test_weekend_week_and_names(spark):
    days = [date(2025, 1, 4), date(2025, 1, 5), date(2025, 1, 6), date(2027, 1, 1)]
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    d = F.col("d")
    assert values(
        frame, C.day_of_week(d), C.weekend(d), F.weekofyear(d), C.weekday_name(d),
        C.month_name_padded(d),
    ) == [
        (6, 1, 1, "Sabado", "January  "), (0, 1, 1, "Domingo", "January  "),
        (1, 0, 2, "Segunda", "January  "), (5, 0, 53, "Sexta", "January  "),
    ]


def test_business_days_match_numpy(spark):
    rng = np.random.default_rng(3)
    starts = np.datetime64("1969-11-20") + rng.integers(0, 25000, 400)
    ends = starts + rng.integers(-10, 60, 400)
    frame = spark.createDataFrame(
        [(a.item(), b.item()) for a, b in zip(starts, ends)], "a date, b date"
    )
    expected = np.busday_count(starts, np.maximum(starts, ends))
    got = [r[0] for r in frame.select(C.business_days(F.col("a"), F.col("b"))).collect()]
    assert got == expected.tolist()


@pytest.mark.parametrize(
    "year, easter",
    [(1961, date(1961, 4, 2)), (2000, date(2000, 4, 23)), (2023, date(2023, 4, 9)),
     (2024, date(2024, 3, 31)), (2025, date(2025, 4, 20)), (2038, date(2038, 4, 25))],
)
def test_easter(spark, year, easter):
    frame = spark.createDataFrame([(year,)], "y int")
    assert values(frame, C.easter_sunday(F.col("y"))) == [(easter,)]


def test_limits_are_strict(spark):
    rows = [(1, 4.0), (1, 4.1), (2, 8.0), (3, 24.0), (4, 72.0), (4, 72.1), (5, 999.0), (None, 9.0)]
    frame = spark.createDataFrame(rows, "p int, h double")
    got = values(frame, X.exceeds(S.EXPECTED_HOURS, F.col("p"), F.col("h")))
    assert [g[0] for g in got] == [0, 1, 0, 0, 0, 1, 0, 0]


@pytest.mark.parametrize(
    "text, exact, cleaned",
    [("SIM", 1, 1), ("NAO", 0, 0), ("Sim", -1, 1), (" SIM ", -1, 1), ("TRUE", -1, 1),
     ("FALSE", -1, 0), (None, -1, 0)],
)
def test_kpi_texts(spark, text, exact, cleaned):
    frame = spark.createDataFrame([(text,)], "k string")
    k = F.col("k")
    assert values(frame, X.kpi_status(k), X.kpi_status_cleaned(k)) == [(exact, cleaned)]


def test_layered_target(tickets):
    made = silver.silver(
        tickets(
            ticket("violated", KPI_Violado="SIM"),
            ticket("child", KPI_Violado="SIM", Incidente_Pai="INC9"),
            ticket("noise", KPI_Violado="SIM", Status=S.NOISE_STATUS),
            ticket("p2 late", KPI_Violado=None, Duracao=4 * 3600 + 1),
            ticket("p2 on time", KPI_Violado=None, Duracao=4 * 3600),
            ticket("p3 late", KPI_Violado=None, Duracao=99 * 3600, Prioridade="3 - Moderada"),
        )
    )
    assert dict(values(made, "Numero", "Target_Risco_SLA")) == {
        "violated": 1, "child": 0, "noise": 0, "p2 late": 1, "p2 on time": 0, "p3 late": 0,
    }


def test_parent_flag_is_taken_before_the_fill(tickets):
    made = silver.silver(tickets(ticket(), ticket("INC2", Incidente_Pai="INC1")))
    assert sorted(values(made, "Numero", "Possui_Pai", "Incidente_Pai")) == [
        ("INC1", 0, "Independente"), ("INC2", 1, "INC1"),
    ]


def test_job_profile_golden_rows(spark):
    rows = [
        ("INC001", "1 - Critica", datetime(2025, 1, 10, 8), 120, True, False, None),
        ("INC002", "2 - Alta", datetime(2025, 1, 11, 9), 240, True, True, None),
        ("INC003", "3 - Media", datetime(2025, 2, 1, 7), 1440, False, False, "INC001"),
    ]
    raw = spark.createDataFrame(
        rows,
        "Numero string, Prioridade string, Aberto timestamp_ntz, Duracao bigint, "
        "Entrou_para_KPI boolean, KPI_Violado boolean, Incidente_Pai string",
    )
    made = silver.silver(raw, "job").orderBy("Numero")
    assert values(
        made, "Duracao_Horas", "Target_Risco_SLA", "Possui_Pai", "Exige_Intervencao",
        "Prioridade_Num", "Ano_Mes",
    ) == [
        (2.0, 1, 0, 1, 1, "2025-01"), (4.0, 1, 0, 1, 2, "2025-01"), (24.0, 1, 1, 0, 3, "2025-02"),
    ]


def test_sentinels_only_in_the_job_profile(tickets):
    raw = tickets(ticket(Resolvido=None))
    assert values(silver.silver(raw), "Resolvido") == [(None,)]
    assert values(silver.silver(raw, "job"), "Resolvido") == [(datetime(1900, 1, 1),)]


def test_boolean_kpi_columns_are_read_as_words(spark):
    raw = spark.createDataFrame([(True, False), (None, True)],
                                "Entrou_para_KPI boolean, KPI_Violado boolean")
    assert values(bronze.coerce_types(raw), "Entrou_para_KPI", "KPI_Violado") == [
        ("SIM", "NAO"), (None, "SIM"),
    ]
    texts = spark.createDataFrame([("NAO", " sim ")], "Entrou_para_KPI string, KPI_Violado string")
    assert values(bronze.kpi_flags(texts), "Entrou_para_KPI", "KPI_Violado") == [(False, True)]


def test_headers():
    assert bronze.plain_name("KPI Violado?") == "KPI_Violado"
    assert bronze.plain_name("Código de fechamento") == "Codigo_de_fechamento"


def test_bad_cells_become_null(spark):
    raw = spark.createDataFrame(
        [("INC1", "abc", "2025-13-01"), ("INC2", "12", "2025-01-02 03:04:05")],
        "`Número` string, `Duração` string, Aberto string",
    )
    assert values(bronze.load_export(raw), "Numero", "Duracao", "Aberto") == [
        ("INC1", None, None), ("INC2", 12, datetime(2025, 1, 2, 3, 4, 5)),
    ]


def test_composite_key_keeps_the_place_of_a_null(spark):
    frame = spark.createDataFrame([(None, "a", "b"), ("a", None, "b"), ("a", "b", None)],
                                  "x string, y string, z string")
    keys = [r[0] for r in frame.select(X.surrogate_key(*[F.col(c) for c in "xyz"])).collect()]
    assert len(set(keys)) == 3 and None not in keys


def test_key_without_stand_ins_would_lose_rows(spark):
    """Why every part of a key has a stand-in: plain concatenation gives null keys."""
    frame = spark.createDataFrame([("a", None)], "x string, y string")
    plain = F.md5(F.concat("x", F.lit("||"), "y"))
    skipping = F.md5(F.concat_ws("||", "x", "y"))
    key = X.surrogate_key(F.col("x"), F.col("y"))
    assert values(frame, plain) == [(None,)]
    assert values(frame, skipping) == values(frame, F.md5(F.lit("a")))
    assert values(frame, key) == values(frame, F.md5(F.lit("a||")))


def test_status_dimension_repeats_keys_and_its_join_form_does_not(tickets):
    made = silver.silver(
        tickets(ticket(Entrou_para_KPI="SIM"), ticket("INC2", Entrou_para_KPI="NAO"))
    )
    dimension = star.status_dimension(made)
    assert dimension.count() == 2
    assert values(star.status_by_key(dimension), "entrou_kpi") == [("SIM",)]


def test_priority_dimension_join_form(tickets):
    made = silver.silver(
        tickets(ticket(Prioridade="3 - Média"), ticket("INC2", Prioridade="3 - Moderada"))
    )
    one = star.priority_by_key(star.priority_dimension(made))
    assert values(one, "prioridade_num", "prioridade_texto") == [(3, "3 - Moderada")] or values(
        one, "prioridade_num", "prioridade_texto") == [(3, "3 - Média")]
    assert one.count() == 1


def test_fractional_seconds(tickets):
    made = marts.base_features(
        silver.silver(
            tickets(
                ticket(Aberto=datetime(2025, 1, 6, 9), Resolvido=datetime(2025, 1, 6, 9, 0, 0, 500000))
            )
        )
    )
    assert values(made, "horas_ate_resolucao") == [(0.5 / 3600,)]


def test_group_guard_is_strict(tickets):
    fifty = [ticket(f"A{i}", Grupo_designado="fifty") for i in range(50)]
    more = [ticket(f"B{i}", Grupo_designado="more", KPI_Violado="SIM") for i in range(51)]
    out = analytics.group_violation_rate(silver.silver(tickets(*fifty, *more)))
    assert values(out, "grupo", "taxa_violacao") == [("more", 100.0)]


def test_weekend_crossing(spark):
    rows = [
        (datetime(2025, 1, 6, 9), datetime(2025, 1, 6, 18), 0),   # Monday, same day
        (datetime(2025, 1, 10, 9), datetime(2025, 1, 10, 18), 1),  # opened on Friday
        (datetime(2025, 1, 9, 9), datetime(2025, 1, 11, 8), 1),   # closed on Saturday
        (datetime(2025, 1, 6, 9), datetime(2025, 1, 8, 9), 1),    # two whole days
        (datetime(2025, 1, 6, 9), datetime(2025, 1, 8, 8), 0),
    ]
    frame = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, w int")
    assert frame.where(C.crosses_weekend(F.col("a"), F.col("b")) != F.col("w")).count() == 0


def test_percentages_round_half_up(spark):
    frame = spark.createDataFrame([(1, 800), (0, 0), (2, 3)], "a int, b int")
    assert values(frame, N.percent_2(F.col("a"), F.col("b"))) == [(0.13,), (None,), (66.67,)]


def test_score_stays_in_range(base):
    low, high = base.agg(
        F.min("score_risco_operacional"), F.max("score_risco_operacional")
    ).first()
    assert 0 <= low <= high <= 8


def test_cells_in_other_forms_are_read(spark):
    raw = spark.createDataFrame(
        [("INC1", "3600.0", "02/01/2025 10:00"), ("INC2", "1.5e3", "02-01-2025 10:00:30"),
         ("INC3", "12.5", "2025-01-02 10:00:00"), ("INC4", "n/d", "amanhã"), ("INC5", "", None),
         ("INC6", "9000000000.00", "31/12/2024")],
        "`Número` string, `Duração` string, `Aberto` string",
    )
    rows = {r["Numero"]: r for r in bronze.load_export(raw).collect()}
    assert [rows[f"INC{k}"]["Duracao"] for k in range(1, 7)] == [3600, 1500, 13, None, None, 9000000000]
    assert rows["INC1"]["Aberto"] == datetime(2025, 1, 2, 10, 0)
    assert rows["INC2"]["Aberto"] == datetime(2025, 1, 2, 10, 0, 30)
    assert rows["INC6"]["Aberto"] == datetime(2024, 12, 31)
    lost = {r["column"]: r["lost"] for r in bronze.lost_cells(raw).collect()}
    assert lost == {"Duracao": 1, "Aberto": 1}
