"""Classification of documents and images by rule tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keywords of document domains, in order of precedence on ties
DOMAINS = {
    "health_economics": ["cost", "QALY", "ICER", "Markov", "willingness-to-pay", "cost-effectiveness", "incremental", "budget impact", "threshold", "cost-utility", "quality-adjusted life year", "cost-benefit", "health economics", "economic evaluation", "survival analysis", "hazard ratio", "Kaplan-Meier", "probabilistic sensitivity", "tornado diagram", "acceptability curve", "net monetary benefit"],
    "clinical_trial": ["randomized", "placebo", "endpoint", "ITT", "CONSORT", "adverse event", "RCT", "trial", "phase", "randomization"],
    "systematic_review": ["PRISMA", "meta-analysis", "forest plot", "I-squared", "pooled", "heterogeneity", "systematic", "review"],
    "hta_regulatory": ["NICE", "DMP", "NoMA", "reimbursement", "submission", "appraisal", "HTA", "regulatory", "guideline"],
    "epidemiology": ["incidence", "prevalence", "registry", "cohort", "DALY", "mortality", "population", "burden", "disease"],
    "methodology": ["model validation", "simulation", "calibration", "structural uncertainty", "sensitivity", "probabilistic"],
    "pharmaceutical": ["pharmacokinetics", "pharmacodynamics", "bioequivalence", "absorption", "clearance", "half-life", "AUC", "Cmax", "bioavailability", "formulation"],
}
# Keywords that decide the domain at once; health_economics is tried first
OVERRIDES = {
    "health_economics": ["Markov model", "cost-effectiveness analysis", "willingness to pay", "ICER", "incremental cost-effectiveness", "cost-utility analysis", "survival analysis", "hazard ratio"],
    "hta_regulatory": ["NoMA", "metodevurdering", "ICER threshold", "cost per QALY", "NICE appraisal", "health technology assessment", "reimbursement decision", "HTA body", "DMP"],
}
# Topics and their keywords
TOPICS = {
    "Introduction to HTA": ["introduction", "framework", "economic evaluation", "hta"],
    "Costs & Costing": ["cost", "costing", "resource use", "friction", "human capital"],
    "Quality of Life / HRQoL": ["quality of life", "hrqol", "eq-5d", "sf-6d", "utility", "qaly"],
    "Modelling": ["model", "markov", "decision tree", "simulation", "extrapolation"],
    "Cost-Effectiveness Analysis": ["icer", "ce plane", "threshold", "cost-effectiveness", "nmb"],
    "Sensitivity & Uncertainty": ["sensitivity", "uncertainty", "tornado", "psa", "ceac", "bootstrap"],
    "Discounting": ["discount", "time preference", "present value"],
    "HTA & Policy Making": ["policy", "reimbursement", "value flower", "nice", "zin"],
    "Transferability": ["transferability", "generalisability", "country", "jurisdiction"],
    "Equity & Distribution": ["equity", "distribution", "qaly weight", "fair innings"],
    "Theoretical Foundations": ["welfare", "welfarism", "extra-welfarism", "capability"],
}
# Source categories by words in a path
SOURCES = {"CURRENT SLIDES": ["current", "2026"], "PREVIOUS SLIDES": ["previous", "2025"], "LITERATURE": ["literature", "paper", "article"], "WORKING GROUP": ["wg", "working group", "workgroup"]}
# Words of a context that point to a figure
FIGURE_WORDS = ["figure", "table", "diagram", "model", "chart", "graph", "plot", "curve", "illustration", "schematic"]
# Failure patterns, first match wins: name, severity, pattern
FAILURES = [
    ("2000px_crash", "CRITICAL", r"exceeds the dimension limit|2000px|dimension limit for many-image"),
    ("blank_image", "MAJOR", r"blank.*image|image.*blank|empty.*image|zero.*byte"),
    ("missing_manifest", "CRITICAL", r"manifest.*not found|no.*manifest|FileNotFoundError.*manifest"),
    ("extraction_failure", "CRITICAL", r"extraction.*fail|failed.*extract|could not extract"),
]
# Personas by image type: always, then those that a word of the context activates
PERSONAS = {
    "kaplan-meier": (["statistician", "visualization_critic"], {"clinical_trialist": ["trial", "arm", "treatment", "group", "randomized", "RCT"], "epidemiologist": ["population", "registry", "cohort", "incidence", "prevalence"], "health_economist": ["extrapolat", "survival model", "partitioned", "QALY", "cost"]}),
    "forest-plot": (["statistician", "visualization_critic"], {"clinical_trialist": ["subgroup", "trial", "ITT", "per-protocol", "arm"], "regulatory_analyst": ["HTA", "systematic review", "submission", "NICE", "DMP", "PRISMA"]}),
    "tornado-diagram": (["health_economist", "statistician", "visualization_critic"], {"regulatory_analyst": ["HTA", "submission", "sensitivity", "DSA"]}),
    "scatter": (["statistician", "visualization_critic"], {"health_economist": ["cost", "ICER", "QALY", "WTP", "incremental", "CE plane"], "epidemiologist": ["population", "registry", "cohort", "correlation"], "regulatory_analyst": ["WTP", "threshold", "CE plane", "HTA"]}),
    "decision-tree": (["model_architect", "health_economist"], {"clinical_trialist": ["treatment", "pathway", "clinical", "arm", "strategy"], "regulatory_analyst": ["HTA", "submission", "model", "DMP", "NICE"]}),
    "flow-chart": (["visualization_critic"], {"clinical_trialist": ["CONSORT", "patient", "randomized", "enrollment", "trial"], "regulatory_analyst": ["PRISMA", "systematic", "review", "regulatory", "process"], "model_architect": ["model", "algorithm", "logic", "decision", "analysis"], "health_economist": ["economic", "model", "cost", "analysis"]}),
    "schematic": (["visualization_critic"], {"model_architect": ["model", "Markov", "state", "transition", "structure"], "health_economist": ["economic", "model", "cost"], "clinical_trialist": ["clinical", "pathway", "treatment", "disease"]}),
    "line-chart": (["visualization_critic"], {"statistician": ["model fit", "statistical", "trend", "regression"], "epidemiologist": ["time trend", "survival", "incidence", "mortality", "temporal"], "health_economist": ["cost", "projection", "CEAC", "acceptability", "budget"]}),
    "bar-chart": (["visualization_critic"], {"epidemiologist": ["disease burden", "prevalence", "incidence", "DALY", "population"], "health_economist": ["cost", "breakdown", "budget impact", "resource use"], "clinical_trialist": ["adverse event", "response rate", "outcome", "trial"]}),
    "table-image": (["visualization_critic"], {"health_economist": ["cost", "QALY", "ICER", "economic", "utility"], "clinical_trialist": ["patient characteristic", "endpoint", "baseline", "outcome"], "statistician": ["statistical", "CI", "p-value", "result", "analysis"]}),
    "histogram": (["statistician", "visualization_critic"], {}),
    "box-plot": (["statistician", "visualization_critic"], {"clinical_trialist": ["clinical", "outcome", "treatment", "arm"]}),
    "heatmap": (["statistician", "visualization_critic"], {}),
    "pie-chart": (["visualization_critic"], {"epidemiologist": ["disease", "distribution", "population", "proportion"]}),
    "funnel-plot": (["statistician", "visualization_critic"], {}),
    "log_cumulative_hazard_plot": (["statistician"], {"clinical_trialist": ["trial", "treatment", "arm", "proportional hazard"]}),
    "network-diagram": (["statistician", "visualization_critic"], {}),
    "photograph": ([], {"epidemiologist": ["disease", "manifestation", "clinical"]}),
    "other": (["visualization_critic"], {}),
    "process_flowchart": (["visualization_critic"], {"regulatory_analyst": ["regulatory", "compliance", "process", "procedure"]}),
    "decorative-background": ([], {}),
    "chart": (["statistician", "visualization_critic", "health_economist", "model_architect"], {"clinical_trialist": ["trial", "arm", "treatment", "endpoint"], "regulatory_analyst": ["HTA", "submission", "NICE"]}),
    "diagram": (["visualization_critic", "model_architect"], {"health_economist": ["economic", "model", "cost", "QALY"], "clinical_trialist": ["clinical", "pathway", "treatment"], "regulatory_analyst": ["HTA", "process", "regulatory"]}),
}


def _hits(low: Column, words: list[str], weight=None) -> Column:
    total = F.lit(0)
    for w in words:
        total = total + (weight(low, w.lower()) if weight else F.contains(low, F.lit(w.lower())).cast("int"))
    return total


def first_most(scores: list[tuple[str, Column]], default: str) -> Column:
    """The name of the greatest score, the first on ties; default if all are 0."""
    best = F.greatest(*[c for _, c in scores])
    out = F.when(best == 0, default)
    for name, c in scores:
        out = out.when(c == best, name)
    return out


def _lowered(text: Column, value: Callable[[Column], Column]) -> Column:
    """value of the lower-cased text, which is made once however often value uses it."""
    return F.get(F.transform(F.array(F.lower(text)), value), F.lit(0))


def _found(low: Column, keywords: list[str]) -> Column:
    """The keywords that low contains."""
    return F.filter(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.contains(low, k))


def domain(text: Column, table: dict[str, list[str]] = DOMAINS, overrides: dict[str, list[str]] = OVERRIDES) -> Column:
    """Overriding keywords first, else the domain with most distinct keywords in the text (substrings, any case; the first on ties), else general; null for null."""

    def named(low: Column) -> Column:
        first = [F.when(F.size(_found(low, k)) > 0, name) for name, k in overrides.items()]
        scores = F.array(*[F.size(_found(low, k)) for k in table.values()])
        most = F.transform(F.array(scores), lambda s: F.when(F.array_max(s) > 0, F.element_at(F.array(*map(F.lit, table)), F.array_position(s, F.array_max(s)).cast("int"))))
        return F.coalesce(*first, F.get(most, F.lit(0)), F.lit("general"))

    return F.when(text.isNotNull(), _lowered(text, named))


def occurrences(text: Column, word: str) -> Column:
    """Non-overlapping occurrences of word, any case."""
    low = F.lower(text)
    return ((F.length(low) - F.length(F.replace(low, F.lit(word.lower()), F.lit("")))) / len(word)).cast("long")


def key_terms(docs: DataFrame, words: list[str], k: int = 5) -> DataFrame:
    """The k most frequent of words in each text, those named first on ties: doc_id, rank, term, n."""
    found = F.array(*[F.struct((-occurrences(F.col("text"), w)).alias("m"), F.lit(i).alias("ord"), F.lit(w).alias("term")) for i, w in enumerate(words)])
    top = F.slice(F.array_sort(F.filter(found, lambda x: x.m < 0)), 1, k)
    return docs.select("doc_id", F.posexplode(top)).select("doc_id", (F.col("pos") + 1).alias("rank"), "col.term", (-F.col("col.m")).alias("n"))


def topic(text: Column, topics: dict[str, list[str]] = TOPICS) -> Column:
    """Two points for a keyword as whole words, one as a substring; most points win, the first on ties."""
    score = lambda low, w: F.when(low.rlike(rf"\b{w}\b"), 2).when(F.contains(low, F.lit(w)), 1).otherwise(0)
    return first_most([(n, _hits(F.lower(text), w, score)) for n, w in topics.items()], "Uncategorised")


def topic_or_document(context: Column, file: Column, topics: dict[str, list[str]] | None) -> Column:
    """The topic of context and file name; without topics the file's stem, so images are grouped by document."""
    name = F.regexp_extract(file, "([^/]*)$", 1)
    stem = F.when(F.coalesce(file, F.lit("")) == "", "Unknown Document").otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""))
    return stem if topics is None else topic(F.concat_ws(" ", context, file), topics)


def source_category(path: Column) -> Column:
    low, out = F.lower(path), None
    for name, words in SOURCES.items():
        hit = _hits(low, words) > 0
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("LITERATURE")


def known_failure(message: Column) -> Column:
    out = None
    for name, severity, pattern in FAILURES:
        hit, value = message.rlike(f"(?i){pattern}"), F.struct(F.lit(name).alias("name"), F.lit(severity).alias("severity"))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def is_branding(w: Column, h: Column, size: Column, page: Column, on_page: Column) -> Column:
    """Logos and page furniture by dimensions, bytes (0: unknown) and place."""
    known = size > 0
    small = known & (size < 5000)
    return (w > 0) & (h > 0) & (
        ((w < 100) & (h < 100))
        | (((w / h > 10) | (w / h < 0.1)) & (size < 5000))
        | (small & F.when(page == 1, (w < 400) | (h < 400)).otherwise((w < 200) & (h < 200)))
        | ((page == 1) & (on_page > 3) & known & (size < 50000) & (w < 500) & (h < 500))
        | ((page == 1) & (on_page > 8) & known & (size < 100000))
        | ((page == 1) & (w < 300) & (h < 300) & known & (size < 50000))
    )


def image_class(images: DataFrame) -> DataFrame:
    """images (doc_id, image_id, page, xref, width, height, size_bytes, on_page, total_pages, source, words, context): adds reason and
    is_substantive by an ordered chain; an xref on more than half of the pages is a watermark."""
    from pyspark.sql.window import Window

    w, h, ctx = F.col("width"), F.col("height"), F.lower("context")
    images = images.withColumn("times", F.count("xref").over(Window.partitionBy("doc_id", "xref")))
    figure = F.lit(False)
    for word in FIGURE_WORDS:
        figure = figure | ctx.contains(word)
    reason = (
        F.when((h > 0) & (h < 50) & (w >= 50), F.concat(F.lit("narrow_fragment (h="), h.cast("string"), F.lit("px)")))
        .when((w > 0) & (w < 50) & (h >= 50), F.concat(F.lit("narrow_fragment (w="), w.cast("string"), F.lit("px)")))
        .when((w < 50) & (h < 50) & (w > 0) & (h > 0), "tiny_dimensions")
        .when(is_branding(w, h, F.col("size_bytes"), F.col("page"), F.col("on_page")), "journal_branding")
        .when(F.col("xref").isNotNull() & (F.col("times") > F.col("total_pages") * 0.5), "repeated_watermark")
        .when((F.col("source") == "vector-render") & (F.col("words") < 20), "low_word_count_render")
        .when((w > 200) & (h > 200) & (F.length("context") > 20), "large_with_context")
        .when(figure, "figure_keyword")
        .otherwise("conservative_default")
    )
    kept = ["large_with_context", "figure_keyword", "conservative_default"]
    return images.withColumn("reason", reason).withColumn("is_substantive", F.col("reason").isin(kept)).drop("times")


def is_decorative(w, h, page, total, context, filename, chart, repeated) -> Column:
    """Office pictures: small, bare background, repeated, or on a title or closing slide."""
    n_words = F.size(F.filter(F.split(context, r"\s+"), lambda x: x != ""))
    low = F.lower(context)
    return ~chart & (
        ((w > 0) & (h > 0) & (w < 50) & (h < 50))
        | ((w >= 7000) & (h >= 4000) & (n_words < 15))
        | repeated
        | ((page == 1) & F.lower(filename).rlike("title|cover"))
        | ((page == total) & low.rlike("thank|question"))
    )


def has_vector_content(drawings: Column, area_pct: Column) -> Column:
    return F.when(drawings >= 50, area_pct >= 1.0).otherwise((drawings >= 7) & (area_pct >= 5.0))


def personas(kind: Column, context: Column) -> Column:
    """The personas, sorted, that an image type and its context activate."""
    none = F.array().cast("array<string>")

    def active(low: Column) -> Column:
        out = F.when(F.lit(False), none)
        for name, (always, conditional) in PERSONAS.items():
            asked = [F.when(F.size(_found(low, words)) > 0, F.lit(who)) for who, words in conditional.items()]
            out = out.when(kind == name, F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.lit(a) for a in always], *asked)))))
        return out.otherwise(none)

    return _lowered(F.coalesce(context, F.lit("")), active)


def column_widths(cells: DataFrame, total_cm: float = 16.0, least: float = 1.5) -> DataFrame:
    """cells (table_id, col_no, row_no, cell): widths by the square root of the mean length, at least `least`, scaled to the total."""
    from pyspark.sql.window import Window

    t = Window.partitionBy("table_id")
    s = cells.groupBy("table_id", "col_no").agg(F.avg(F.length("cell")).alias("m"), F.max(F.when(F.col("row_no") == 0, F.length("cell"))).alias("head"))
    s = s.withColumn("r", F.sqrt(F.greatest("m", F.col("head").cast("double"), F.lit(3.0))))
    s = s.withColumn("w", F.greatest(F.col("r") / F.sum("r").over(t) * total_cm, F.lit(least)))
    return s.select("table_id", "col_no", F.round(F.col("w") / F.sum("w").over(t) * total_cm, 6).alias("width_cm"))
