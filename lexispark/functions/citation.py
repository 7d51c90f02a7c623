"""Citation parser: author, work and place of references such as 'Cic. Div. 1, 23', with a confidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispark.functions.strings import let

# Literal clean-up steps and letter classes, in the order they apply.
REPLACEMENTS = (("—", "-"), ("–", "-"), ("•", ""), ("·", "."), ("..", "."), (" ,", ","), (" , ", ", "), (" .", "."), ("cit. LS", ""), ("(cit. LS)", ""))
ALIASES = (("1 Ped.", "1 Pet."), ("App. M.", "Apul. M."))
UPPER = "A-ZÁÉÍÓÚÂÊÎÔÛÃÕÀÇ"
PLACE = r"(?i)\d|pr\.|pref\."  # a place has a number or points to a preface


def split_reference(c: Column, authors: tuple[str, ...] = (), works: tuple[str, ...] = ()) -> Column:
    """Struct of a reference: ``fonte, obra, loc, status, confidence, err_msg``.

    Empty text is invalid with confidence 0; a text without author and place is invalid (at most 0.2); a missing work
    makes it partial (at most 0.6); a place without digits makes it partial (at most 0.4); odd characters cost 0.2. Where
    abbreviations of authors or works are given, one that is not among them is noted and costs 0.15 or 0.1.
    """
    full = rf"^([{UPPER}][A-Za-z{UPPER}. ]+?)\s+([A-Za-z{UPPER}][A-Za-z{UPPER}. ]+?)\s+(.+)$"
    short = rf"^([{UPPER}][A-Za-z{UPPER}. ]+?)\s+(.+)$"

    def clean(raw: Column) -> Column:
        x = raw
        for wrong, right in REPLACEMENTS:
            x = F.replace(x, F.lit(wrong), F.lit(right))
        x = F.trim(F.regexp_replace(F.regexp_replace(x, r"[;,.)\]]+$", ""), r"(?U)\s+", " "))
        for wrong, right in ALIASES:
            x = F.replace(x, F.lit(wrong), F.lit(right))
        return x

    def parts(x: Column, raw: Column) -> Column:
        has_full, has_short = x.rlike(full), x.rlike(short)
        fonte = F.when(has_full, F.regexp_extract(x, full, 1)).when(has_short, F.regexp_extract(x, short, 1))
        loc = F.when(has_full, F.regexp_extract(x, full, 3)).when(has_short, F.regexp_extract(x, short, 2))
        return F.struct((raw == "").alias("blank"), x.rlike(r"(?U)[^\w.,\-\s()]").alias("odd"), fonte.alias("fonte"), F.when(has_full, F.regexp_extract(x, full, 2)).alias("obra"), loc.alias("loc"))

    def judged(p: Column) -> Column:
        empty, odd = p["blank"], ~p["blank"] & p["odd"]
        none = ~p["blank"] & p["fonte"].isNull()
        alone = p["fonte"].isNotNull() & p["obra"].isNull()
        no_digits = p["loc"].isNotNull() & ~p["loc"].rlike(r"\d")
        note = p["loc"].isNotNull() & ~p["loc"].rlike(PLACE)
        issues = F.concat_ws(",", F.when(empty, "vazio"), F.when(odd, "caracteres_estranhos"), F.when(none, "nao_casou"), F.when(alone, "obra_ausente"), F.when(no_digits, "sem_numeros_em_loc"))
        stranger = lambda part, known: F.coalesce(~F.rtrim(F.get(F.split(part, " "), F.lit(0)), F.lit(".")).isin([x.rstrip(".") for x in known]), F.lit(False)) if known else F.lit(False)
        author, work = stranger(p["fonte"], authors), stranger(p["obra"], works)
        full = F.lit(0.9) - F.when(author, 0.15).otherwise(0.0) - F.when(work, 0.1).otherwise(0.0)
        base = F.when(empty, 0.0).when(none, F.least(full, F.lit(0.2))).when(alone, F.least(full, F.lit(0.6))).otherwise(full)
        less = F.when(odd, base - 0.2).otherwise(base)
        conf = F.when(no_digits, F.least(less, F.lit(0.4))).otherwise(less)
        status = F.when(empty | none, "invalido").when(no_digits | alone, "parcial").otherwise("ok")
        notes = F.concat_ws(",", F.when(note, "loc_formato_atipico"), F.when(author, "autor_desconhecido"), F.when(work, "obra_desconhecida"))
        message = F.nullif(F.concat_ws("; ", F.when(issues != "", F.concat(F.lit("issues="), issues)), F.when(notes != "", F.concat(F.lit("notes="), notes))), F.lit(""))
        return F.struct(p["fonte"].alias("fonte"), p["obra"].alias("obra"), p["loc"].alias("loc"), status.alias("status"), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), conf)), 6).alias("confidence"), message.alias("err_msg"))

    raw = F.coalesce(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), F.lit(""))
    both = F.struct(raw.alias("raw"), clean(raw).alias("x"))
    return let(let(both, lambda s: parts(s["x"], s["raw"])), judged)


def reference_text(fonte: Column, obra: Column, loc: Column, raw: Column) -> Column:
    """Canonical reference string, or the raw one where no part is known."""
    return F.coalesce(F.nullif(F.trim(F.concat_ws(" ", fonte, obra, loc)), F.lit("")), raw)
