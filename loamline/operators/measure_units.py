"""Quantities recorded in different units, scales and currencies, brought to common units."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.session import broadcast_within, cut_lineage

# Spellings of the reference table's symbols, lower case.
SPELLINGS = {
    "kg": ["kg", "kgs", "kilo", "kilos", "kilogram", "kilograms", "kilogramme", "kilogrammes"],
    "g": ["g", "gr", "gm", "gms", "gram", "grams", "gramme", "grammes"],
    "lb": ["lb", "lbs", "pound", "pounds"],
    "oz": ["oz", "ounce", "ounces"],
    "quintal": ["quintal", "quintals", "qtl", "qtls"],
    "tonne": ["tonne", "tonnes", "t", "mt", "metric ton", "metric tons", "metric tonne", "metric tonnes"],
    "short ton": ["short ton", "short tons", "us short ton", "us short tons", "us ton"],
    "L": ["l", "lt", "ltr", "ltrs", "liter", "liters", "litre", "litres"],
    "mL": ["ml", "mls", "milliliter", "milliliters", "millilitre", "millilitres"],
    "cL": ["cl", "centiliter", "centiliters", "centilitre", "centilitres"],
    "US gallon": ["us gallon", "us gallons", "us gal", "gal (us)", "gallon (us)"],
    "imperial gallon": ["imperial gallon", "imperial gallons", "imp gal", "gal (imp)", "imp gallon", "gallon (imp)"],
    "ea": ["ea", "each", "pc", "pcs", "piece", "pieces", "unit", "units", "head", "heads"],
    "dozen": ["dozen", "dozens", "doz", "dz"],
    "tray": ["tray", "trays"],
    "score": ["score", "scores"],
}
# Spellings of containers whose usual size depends on the country.
CONTAINERS = {
    "bag": ["bag", "bags", "sack", "sacks", "sack (bag)"],
    "debe": ["debe", "debes"],
    "mudu": ["mudu", "mudus"],
    "olonka": ["olonka", "olonkas"],
    "gorogoro": ["gorogoro", "gorogoros"],
    "pail": ["pail", "pails"],
    "tia": ["tia", "tias"],
    "jerrycan": ["jerrycan", "jerrycans", "jerry can", "jerry cans", "jerrican", "jerricans"],
    "bidon": ["bidon", "bidons"],
}
# Packages that say nothing of the size.
PACKAGES = ["pack", "packs", "packet", "packets", "tin", "tins", "bottle", "bottles", "box", "boxes"]
# Spellings of whole currencies, lower case without dots.
CURRENCIES = {
    "KES": ["kes", "ksh", "kenya shilling", "kenya shillings", "kenyan shilling", "kenyan shillings"],
    "UGX": ["ugx", "ush", "uganda shilling", "uganda shillings", "ugandan shilling", "ugandan shillings"],
    "TZS": ["tzs", "tsh", "tanzania shilling", "tanzania shillings", "tanzanian shilling", "tanzanian shillings"],
    "ETB": ["etb", "birr", "ethiopian birr"],
    "RWF": ["rwf", "frw", "rwanda franc", "rwandan franc", "rwanda francs", "rwandan francs"],
    "MWK": ["mwk", "mk", "malawi kwacha", "malawian kwacha"],
    "ZMW": ["zmw", "zk", "zambian kwacha", "zambia kwacha"],
    "NGN": ["ngn", "naira", "₦", "nigerian naira"],
    "GHS": ["ghs", "gh₵", "gh¢", "ghana cedi", "ghana cedis", "cedi", "cedis"],
    "XOF": ["xof", "cfa", "fcfa", "f cfa", "cfa franc", "cfa francs"],
    "MZN": ["mzn", "mt", "metical", "meticais"],
    "USD": ["usd", "us$", "us dollar", "us dollars", "$", "dollar", "dollars"],
}
NAMES_NONE = ["", "-", "--", "n/a", "na", "none", "null", "unknown", "?"]

_NUMBER = r"\d+ \d/\d|\d+/\d+|\d*[½¼¾]|\d{1,3}(?:,\d{3})+(?:[.]\d+)?|\d+(?:[.,]\d+)?"


def _any(words: list[str]) -> str:
    quote = lambda w: w.replace("(", r"\(").replace(")", r"\)").replace("$", r"\$")
    return "|".join(quote(w) for w in sorted(words, key=lambda w: (-len(w), w)))


def _all(table: dict[str, list[str]]) -> list[str]:
    return [w for words in table.values() for w in words]


_STANDARD, _CONTAINER, _PACKAGE = _any(_all(SPELLINGS)), _any(_all(CONTAINERS)), _any(PACKAGES)
_LEAD = r"(?:per[ _]+)?"
# a number (or none) of a standard unit, in a package or container; a container of a stated size; a bare container
_SIZED = rf"{_LEAD}(?:(\d+) ?[x×] ?)?({_NUMBER})?[ _-]*({_STANDARD})((?:[ _-]+(?:{_PACKAGE}|{_CONTAINER}))?)"
_HOLDING = rf"{_LEAD}(?:1[ _-]+)?(?:{_CONTAINER})[ _-]*(?:of[ _-]*|\()?({_NUMBER})[ _-]*({_STANDARD})\)?"
_BARE = rf"{_LEAD}({_NUMBER})?[ _-]*({_CONTAINER})"


def _plain(text: Column) -> Column:
    """Lower case, single spaces, no dots at the end."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(text), r"[\s ]+", " ")), r"[ .;]+$", "")


def _number(text: Column) -> Column:
    """A written number; 1 where there is none."""
    part = F.when(F.endswith(text, F.lit("½")), 0.5).when(F.endswith(text, F.lit("¼")), 0.25).when(F.endswith(text, F.lit("¾")), 0.75)
    whole = F.coalesce(F.regexp_replace(text, "[½¼¾]", "").try_cast("double"), F.lit(0.0))
    over = F.regexp_extract(text, r"(\d+)/\d+$", 1).try_cast("double") / F.nullif(
        F.regexp_extract(text, r"\d+/(\d+)$", 1).try_cast("double"), F.lit(0.0)
    )
    mixed = F.coalesce(F.regexp_extract(text, r"^(\d+) \d/\d$", 1).try_cast("double"), F.lit(0.0))
    decimal = F.when(
        text.rlike(r"^\d{1,3}(,\d{3})+([.]\d+)?$"), F.regexp_replace(text, ",", "").try_cast("double")
    ).otherwise(F.replace(text, F.lit(","), F.lit(".")).try_cast("double"))
    return F.when(text == "", 1.0).when(text.rlike("[½¼¾]$"), whole + part).when(text.contains("/"), mixed + over).otherwise(decimal)


def _lookup(table: dict[str, list[str]], word: Column) -> Column:
    pairs = [x for symbol, words in table.items() for w in words for x in (F.lit(w), F.lit(symbol))]
    return F.try_element_at(F.create_map(*pairs), word)


def names_none(text: Column) -> Column:
    """Whether a unit or currency field names none."""
    return F.coalesce(F.trim(F.lower(text)).isin(NAMES_NONE), F.lit(True))


def parse_unit(df: DataFrame, text: Column, whole: Column, prefix: str) -> DataFrame:
    """Adds ``{prefix}symbol, {prefix}quantity, {prefix}container`` (null where the text names no unit that is known).

    A size written out prevails over the container it is in. whole: whether the text is the unit; else the unit ends it.
    """
    begin = r"^(?:\x01|[^\x01]*?(?:[,/-] ?|\s))"
    t, kind, num, word, times = (f"_{prefix}{x}" for x in ("t", "kind", "num", "word", "times"))
    sized, holding, bare = (f"{begin}{p}$" for p in (_SIZED, _HOLDING, _BARE))
    df = df.withColumn(t, F.concat(F.when(whole, F.lit("\x01")).otherwise(F.lit("")), _plain(text)))
    df = df.withColumn(
        kind,
        F.when(F.col(t).rlike(holding), "holding").when(F.col(t).rlike(sized), "sized").when(F.col(t).rlike(bare), "bare"),
    )
    e = lambda p, i: F.regexp_extract(F.col(t), p, i)
    by = lambda a, b, c: F.when(F.col(kind) == "holding", a).when(F.col(kind) == "sized", b).when(F.col(kind) == "bare", c)
    df = df.withColumns({
        num: by(e(holding, 1), e(sized, 2), e(bare, 1)),
        word: by(e(holding, 2), e(sized, 3), e(bare, 2)),
        times: F.when(F.col(kind) == "sized", e(sized, 1)).otherwise(""),
        f"_{prefix}tail": F.when(F.col(kind) == "sized", e(sized, 4)).otherwise(""),
    })
    known = (F.col(f"_{prefix}tail") == "") | (F.col(num) != "")  # "kg bag" states no size
    return df.withColumns({
        f"{prefix}container": F.when(F.col(kind) == "bare", _lookup(CONTAINERS, F.col(word))),
        f"{prefix}symbol": F.when((F.col(kind) != "bare") & known, _lookup(SPELLINGS, F.col(word))),
        f"{prefix}quantity": _number(F.col(num)) * _number(F.col(times)),
    }).drop(t, kind, num, word, times, f"_{prefix}tail")


MAX_REFERENCE_ROWS = 100_000  # a reference table beyond this is joined by shuffle instead of broadcast


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a reference table of proven size; leave a larger one to the planner."""
    return F.broadcast(df) if df.limit(MAX_REFERENCE_ROWS + 1).count() <= MAX_REFERENCE_ROWS else df


def _units(keys: DataFrame, everywhere: DataFrame) -> DataFrame:
    """``(_key, _named, _container, _quantity, _u1, _f1)`` of spellings ``_key``: a unit field after a mark, else a series' name."""
    own = F.startswith("_key", F.lit("\x01"))
    tail = F.regexp_replace(_plain(F.col("_key")), r"\s*[,/-]\s*[a-z]{3}$", "")
    parsed = parse_unit(keys.where(F.col("_key").isNotNull()), F.when(own, F.substring("_key", 2, 1_000_000)).otherwise(tail), own, "_")
    named = own | F.col("_symbol").isNotNull() | F.col("_container").isNotNull()
    return parsed.join(everywhere, "_symbol", "left").select("_key", named.alias("_named"), "_container", "_quantity", "_u1", "_f1")


def _currencies(keys: DataFrame, sub: DataFrame) -> DataFrame:
    """``(_cc, _money, _scale, _usd)`` of countries and currency fields: what a stated value is multiplied by, and whether by the
    exchange rate too; a null scale where the currency is not known."""
    df = keys.join(sub, "_cc", "left").withColumn("_code", F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim("_money")), r"[.]", ""), r"\s+", " ")))
    c = F.col("_code")
    thousands = F.when(c.rlike(r"(^thousands? | thousands?$| '?000$)"), 1000.0).otherwise(1.0)
    iso = _lookup(CURRENCIES, F.regexp_replace(c, r"^thousands? (?:of )?| thousands?$| '?000$", ""))
    plain = lambda x: F.regexp_replace(x, "s$", "")
    named = plain(F.regexp_extract(c, r"([^ ()]+)\)?$", 1)) == plain(F.col("_sub"))
    subunit = F.coalesce(F.regexp_replace(c, r"[()]", "").rlike(r"(^| )") & named, F.lit(False))
    local = iso.isNotNull() & F.coalesce(iso == F.col("_cur"), F.lit(True))
    none = names_none(F.col("_money"))
    scale = F.when(none, 1.0).when(subunit, F.col("_fsub")).when(iso == "USD", thousands).when(local, thousands)
    return df.select(F.col("_cc").alias("_cc2"), F.col("_money").alias("_money2"), scale.alias("_scale"), (~none & ~subunit & F.coalesce(iso == "USD", F.lit(False))).alias("_usd"))


def convert_prices(prices: DataFrame, reference: DataFrame) -> DataFrame:
    """``prices`` with ``to_unit, unit_factor, unit_from, currency_factor, converted_price, status``.

    converted_price is local currency per common unit (kg, L, ea): value x currency_factor / unit_factor. The row's own ``unit``
    prevails; only if it names none does the end of ``dataseries_name`` count. A written size prevails over the country's
    usual size of a container. A missing currency is the country's own in whole units; subunits and thousands are scaled, USD
    is multiplied by ``exchange_rate``. status: ``converted``, ``no_unit`` (none named anywhere: for the classifier),
    ``unit_unknown`` or ``currency_unknown`` (named, but not convertible) or ``no_value``.

    Null or NaN values, empty texts, unknown countries and an empty table give defined statuses, never errors. Every input
    row comes out once, repeated rows too; columns of ``prices`` with the new names are replaced.

    Plan: every spelling of a unit, a series or a currency is parsed once, by Catalyst expressions, and joined back; spellings
    are broadcast where they are few (checked), else joined by shuffle, and so is the reference table (MAX_REFERENCE_ROWS).
    """
    added = ["to_unit", "unit_factor", "unit_from", "currency_factor", "converted_price", "status"]
    df = prices.drop(*added).withColumns({"_own": ~names_none(F.col("unit")), "_cc": F.upper(F.trim("country_code")), "_money": F.col("currency").cast("string")})
    df = df.withColumn("_key", F.when(F.col("_own"), F.concat(F.lit("\x01"), "unit")).otherwise(F.col("dataseries_name")))

    ref = reference.select("measure", "symbol", "country_code", "common_unit", F.col("factor").cast("double").alias("factor")).where(
        F.col("symbol").isNotNull() & F.col("factor").isNotNull()
    )
    ref = ref.groupBy("measure", "symbol", "country_code").agg(F.min(F.struct("common_unit", "factor")).alias("r")).select("measure", "symbol", "country_code", "r.common_unit", "r.factor")
    one = lambda rows, by, *columns: rows.select(*by, F.struct(*columns).alias("s")).groupBy(*[c for c in rows.select(*by).columns]).agg(F.min("s").alias("s"))
    everywhere = one(ref.where((F.col("measure") != "currency") & F.col("country_code").isNull()), [F.col("symbol").alias("_symbol")], F.col("common_unit").alias("_u1"), F.col("factor").alias("_f1")).select("_symbol", "s.*")
    usual = one(
        ref.where((F.col("measure") != "currency") & F.col("country_code").isNotNull()), [F.col("symbol").alias("_container"), F.upper("country_code").alias("_cc")],
        F.col("common_unit").alias("_u2"), F.col("factor").alias("_f2"),
    ).select("_container", "_cc", "s.*")
    sub = one(
        ref.where((F.col("measure") == "currency") & F.col("country_code").isNotNull()), [F.upper("country_code").alias("_cc")],
        F.lower("symbol").alias("_sub"), F.col("common_unit").alias("_cur"), F.col("factor").alias("_fsub"),
    ).select("_cc", "s.*")

    spelled = cut_lineage(_units(df.select("_key").distinct(), everywhere))
    money = cut_lineage(_currencies(df.select("_cc", "_money").distinct(), _small(sub)))
    df = df.join(broadcast_within(spelled), "_key", "left").join(_small(usual), ["_container", "_cc"], "left")
    small = broadcast_within(money)
    df = df.join(small, df["_cc"].eqNullSafe(small["_cc2"]) & df["_money"].eqNullSafe(small["_money2"]), "left")
    value = F.when(~F.isnan(F.col("value").cast("double")), F.col("value").cast("double"))
    factor = F.col("_quantity") * F.coalesce("_f1", "_f2")
    df = df.withColumns({
        "to_unit": F.coalesce("_u1", "_u2"), "unit_factor": F.when(factor > 0, factor), "unit_from": F.when(F.col("_own"), "row").when(F.col("_named"), "series"),
        "currency_factor": F.col("_scale") * F.when(F.col("_usd"), F.col("exchange_rate")).otherwise(1.0),
    })
    df = df.withColumn("converted_price", value * F.col("currency_factor") / F.col("unit_factor"))
    df = df.withColumn(
        "status",
        F.when(value.isNull(), "no_value")
        .when(F.col("unit_from").isNull(), "no_unit")
        .when(F.col("unit_factor").isNull(), "unit_unknown")
        .when(F.col("currency_factor").isNull(), "currency_unknown")
        .otherwise("converted"),
    )
    return df.drop("_own", "_cc", "_money", "_key", "_named", "_container", "_quantity", "_u1", "_f1", "_u2", "_f2", "_cc2", "_money2", "_scale", "_usd")


MAX_TRAINING_ROWS = 20_000  # bound of the labelled sample that the classifier is fitted and calibrated on
_CATEGORIES = ["product", "country_code", "price_type", "source_organization", "unit_type", "common_unit"]
_HASHED_TO = 64


def _features(df: DataFrame) -> DataFrame:
    """Magnitudes, neighbouring fields and hashed categories as a vector; defined for nulls in any of them."""
    log = lambda c: F.coalesce(F.when(c > 0, F.log10(c)), F.lit(-9.0))
    value = F.nanvl(F.col("value").cast("double"), F.lit(0.0)) * F.coalesce(F.col("currency_factor"), F.lit(1.0))
    price = F.nanvl(F.col("common_unit_price").cast("double"), F.lit(0.0))
    usd = F.nanvl(F.col("common_currency_price").cast("double"), F.lit(0.0)) * F.coalesce(F.col("exchange_rate"), F.lit(0.0))
    df = df.withColumns({"_x0": log(value), "_x1": log(price), "_x2": log(value / F.nullif(price, F.lit(0.0))),
                         "_x3": log(value / F.nullif(usd, F.lit(0.0)))})
    hashed = {f"_c{i}": F.pmod(F.xxhash64(F.coalesce(F.lower(F.trim(F.col(c))), F.lit(""))), F.lit(_HASHED_TO)).cast("double")
              for i, c in enumerate(_CATEGORIES)}
    return df.withColumns(hashed)


def impute_units(
    converted: DataFrame, *, confident: float = 0.9, max_training_rows: int = MAX_TRAINING_ROWS, seed: int = 7
) -> DataFrame:
    """Decides the rows of ``convert_prices`` whose own field names no unit, from magnitude, source, category and neighbours.

    Adds ``model_unit, model_factor, confidence, decision`` to those rows: ``convert`` where the calibrated probability is at
    least ``confident`` (then ``model_price`` is the converted price), else ``review``. A random forest is fitted on a sample
    of at most ``max_training_rows`` rows whose own unit is known; its top probability is calibrated by isotonic regression
    on the half of the sample that the forest has not seen. Every other stage covers all rows.

    With fewer than 50 labelled rows, or one unit only, nothing can be learned: all rows go to ``review`` with null confidence.
    An empty table gives none. Columns with the new names are replaced.
    """
    added = ["model_unit", "model_factor", "confidence", "decision", "model_price"]
    converted = converted.drop(*added)
    todo = converted.where(F.coalesce(F.col("unit_from") != "row", F.lit(True)))
    label = F.concat_ws("|", "to_unit", F.format_string("%.6g", F.col("unit_factor")))
    known = converted.where((F.col("unit_from") == "row") & (F.col("status") == "converted")).withColumn("_label", label)
    # drawn by a hash of the rows, so that a retry draws the same sample
    share = min(1.0, 0.95 * max_training_rows / max(1, known.count()))
    by_hash = F.pmod(F.xxhash64(F.lit(seed), "id", "dataseries", "value", "period_date"), F.lit(1_000_003)) < share * 1_000_003
    drawn = known.where(by_hash).limit(max_training_rows)
    columns = ["_x0", "_x1", "_x2", "_x3", *[f"_c{i}" for i in range(len(_CATEGORIES))]]
    drawn = _features(drawn).select("_label", *columns).toPandas()
    common = drawn["_label"].value_counts()
    drawn = drawn[drawn["_label"].isin(common[common >= 3].index)]
    if len(drawn) < 50 or drawn["_label"].nunique() < 2:
        return todo.withColumns({
            "model_unit": F.lit(None).cast("string"), "model_factor": F.lit(None).cast("double"), "confidence": F.lit(None).cast("double"),
            "decision": F.lit("review"), "model_price": F.lit(None).cast("double"),
        })
    spark = converted.sparkSession
    fit, held = spark.createDataFrame(drawn.iloc[::2]), spark.createDataFrame(drawn.iloc[1::2])
    index = StringIndexer(inputCol="_label", outputCol="_y", handleInvalid="keep").fit(fit)
    model = Pipeline(stages=[
        index, VectorAssembler(inputCols=columns, outputCol="_v", handleInvalid="keep"),
        RandomForestClassifier(featuresCol="_v", labelCol="_y", predictionCol="_p", probabilityCol="_q", rawPredictionCol="_r",
                               numTrees=20, maxDepth=10, maxBins=128, minInstancesPerNode=2, seed=seed, subsamplingRate=0.7),
        IndexToString(inputCol="_p", outputCol="_said", labels=[*index.labels, "__unseen"]),
    ]).fit(fit)
    top = F.array_max(vector_to_array("_q"))
    judged = model.transform(held).select(top.alias("_top"), (F.col("_said") == F.col("_label")).cast("double").alias("_hit"))
    calibrate = IsotonicRegression(featuresCol="_top", labelCol="_hit", predictionCol="confidence").fit(judged)
    # the forest needs no label on rows to decide; the indexer keeps unknown ones
    done = model.transform(_features(todo).withColumn("_label", F.lit("__none"))).withColumn("_top", top)
    done = calibrate.transform(done).withColumns({
        "model_unit": F.split_part("_said", F.lit("|"), F.lit(1)),
        "model_factor": F.split_part("_said", F.lit("|"), F.lit(2)).try_cast("double"),
    })
    sure = F.coalesce(F.col("confidence") >= confident, F.lit(False)) & F.col("model_factor").isNotNull()
    price = F.col("value").cast("double") * F.col("currency_factor") / F.col("model_factor")
    done = done.withColumns({"decision": F.when(sure, "convert").otherwise("review"), "model_price": F.when(sure, price)})
    return done.select(*todo.columns, *added)


def harmonise_prices(prices: DataFrame, reference: DataFrame, **how: float) -> DataFrame:
    """``convert_prices`` with the classifier deciding the rows that name no unit anywhere.

    Adds to the columns of ``convert_prices`` those of ``impute_units``, null on rows that named their unit. Rows that the
    classifier is sure of get status ``imputed`` and their converted price, the others ``review``. The forest is fitted only
    if there is such a row.
    """
    base = convert_prices(prices, reference)
    none = {
        "model_unit": F.lit(None).cast("string"), "model_factor": F.lit(None).cast("double"),
        "confidence": F.lit(None).cast("double"), "decision": F.lit(None).cast("string"), "model_price": F.lit(None).cast("double"),
    }
    open_rows = base.where(F.col("status") == "no_unit")
    if open_rows.isEmpty():
        return base.withColumns(none)
    decided = impute_units(base, **how).where(F.col("status") == "no_unit")
    decided = decided.withColumns({
        "status": F.when(F.col("decision") == "convert", "imputed").otherwise("review"),
        "converted_price": F.col("model_price"), "to_unit": F.col("model_unit"), "unit_factor": F.col("model_factor"),
    })
    return base.where(F.col("status") != "no_unit").withColumns(none).unionByName(decided)
