"""Rules on ticket attributes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from oncallmart import schema as S


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def priority_number(text: Column) -> Column:
    digit = F.regexp_extract(text, r"(\d)", 1).try_cast("int")
    return F.coalesce(digit, F.lit(S.FALLBACK_PRIORITY))


def priority_from_exact_text(text: Column) -> Column:
    out = F.lit(S.FALLBACK_PRIORITY)
    for label, number in reversed(S.JOB_PRIORITY_TEXT.items()):
        out = F.when(text == label, number).otherwise(out)
    return out


def needs_intervention(status: Column) -> Column:
    # An unknown status counts as real work.
    return flag(~status.eqNullSafe(F.lit(S.NOISE_STATUS)))


def said_yes(text: Column) -> Column:
    return F.upper(F.trim(text)).isin("SIM", "TRUE")


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)


def kpi_status(text: Column) -> Column:
    """SIM/NAO to 1/0; anything else is unknown (-1)."""
    return F.when(text == "SIM", 1).when(text == "NAO", 0).otherwise(-1)


def kpi_status_cleaned(text: Column) -> Column:
    """Forgiving reading of the flag, where unknown counts as not violated."""
    return flag(said_yes(text))


def risk_target(kpi: Column, priority: Column, hours: Column, has_parent: Column,
                intervention: Column) -> Column:
    """Layered target: exemptions, then the KPI flag, then the P2 heuristic."""
    unrecorded_p2 = (kpi == -1) & (priority == 2) & (hours > S.CONTRACT_HOURS[2])
    return (
        F.when((has_parent == 1) | (intervention == 0), 0)
        .when((kpi == 1) | unrecorded_p2, 1)
        .otherwise(0)
    )


def risk_target_any(violated: Column, priority: Column, hours: Column) -> Column:
    """Target of the job profile: any one sign of risk is enough."""
    signs = [violated, priority <= 2, hours > 8]
    known = [F.coalesce(sign, F.lit(False)) for sign in signs]
    return flag(known[0] | known[1] | known[2])


def exceeds(limits: dict[int, int], priority: Column, hours: Column) -> Column:
    over = F.lit(False)
    for number, limit in limits.items():
        over = over | ((priority == number) & (hours > limit))
    return flag(over)


def limit_hours(limits: dict[int, int], priority: Column) -> Column:
    return F.element_at(
        F.create_map(*[F.lit(v) for pair in limits.items() for v in pair]), priority
    )


def operational_risk_score(target: Column, priority: Column, intervention: Column,
                           has_parent: Column, off_hours: Column) -> Column:
    return (
        3 * flag(target == 1)
        + 2 * flag(priority <= 2)
        + flag(intervention == 1)
        + flag(has_parent == 1)
        + off_hours
    )


def priority_bucket(priority: Column) -> Column:
    named = F.element_at(
        F.create_map(*[F.lit(v) for pair in S.PRIORITY_BUCKETS.items() for v in pair]),
        priority,
    )
    return F.coalesce(named, F.lit("Nao Classificada"))


def surrogate_key(*parts: Column, missing: tuple[str, ...] | None = None) -> Column:
    """MD5 over the parts; a null part keeps its place as its stand-in text."""
    stand_ins = missing or ("",) * len(parts)
    texts = [F.coalesce(p.cast("string"), F.lit(m)) for p, m in zip(parts, stand_ins)]
    joined = texts[0]
    for text in texts[1:]:
        joined = F.concat(joined, F.lit("||"), text)
    return F.md5(joined)


def audit_label(priority: Column, hours: Column, kpi: Column, has_parent: Column,
                status: Column) -> Column:
    """Does the recorded KPI flag agree with the contract limit?"""
    exempt = (has_parent == 1) | status.eqNullSafe(F.lit(S.NOISE_STATUS))
    late = hours > limit_hours(S.CONTRACT_HOURS, priority)

    def sla(kind: str) -> Column:
        return F.concat(F.lit(f"SLA: {kind} (P"), priority.cast("string"), F.lit(")"))

    return (
        F.when(exempt & (kpi == 1), "Elegibilidade: Erro (KPI em Incidente Pai/Sem Interv)")
        .when(exempt, "Fora do KPI (Isento por regra)")
        .when(~priority.isin(list(S.CONTRACT_HOURS)), "OK (Conforme)")
        .when(late & (kpi == 0), sla("Falso Negativo"))
        .when(~late & (kpi == 1), sla("Falso Positivo"))
        .when((kpi == -1) & (priority <= 3), sla("Sem Registro"))
        .when(kpi == -1, "Fora do KPI (P4/P5 sem medição estrita)")
        .otherwise("OK (Conforme)")
    )
