"""Merged page texts cut into categories by ranges of lines: ranges found by rule, repaired, trimmed, checked and written out.

Lines have (keys..., line_no, line), ranges (keys..., category, lo, hi). Everything is done on lines and ranges with windows over
one document; no document is gathered but where its text is put together again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonde.operators import intervals, text
from sonde.operators.routing import BREAKS, CATEGORIES, FAMILIES, holds, ordered

# Lines that end a range, numbered questions, what anchors ranges found by rule.
MARKER = r"^\s*\[SOURCE_IMAGE:\s*[^\]]+\]\s*$"
NUMBERED = r"^\s*(\d{1,2})\.\s*"
MORNING_TITLE = "아침 질문 사항"
DREAMS = ("꿈을 많이 꾸십니까", "고약한 잠버릇", "꿈에서의 행동", "잠자는 동안 몸부림", "수면 중 소리를 지르", "팔을 휘두르", "신경계 질환이 있다", "렘수면행동장애", "rbdsq", "rem sleep behavior")
SYMPTOMS = ("밤에 몇 번 깨십니까", "낮에 과도하게 졸립니까", r"몸[이에]\s*실제로 힘이 빠져", "환각이나 꿈 같은 이미지를 본 적이 있습니까", "온몸이 마비되는 듯한 느낌", "당신의 불면증이 위의 증상으로 인한 것으로 생각되십니까")
CHECKLIST = ("Snoring\\s*/\\s*Apnea", "EDS", "Cataplexy", "Sleep attack", "Hypnagogic hallucinations?", "Sleep paralysis", "Insomnia", "Morning headache", "Awakening during sleep")
TICKED = r"\b.*(?:\[selected!|\[not selected)"
SLEEP_HISTORY = ("일주일에 몇 일이나 5분 이상의 낮잠", "화장실을 가기 위해 잠에서 깨는 경우", "밤에 수면시간이 충분하다고 느끼십니까", "나는 내 수면이")
HISTORY_FIRST, HISTORY_AFTER, HISTORY_BACK = r"^\s*9\.\s*", r"^\s*14\.\s*", 8
PERSON_STOP = r"^\s*(병력과 가족력|생활 습관|수면 습관|주증상:|1\.\s*현재 앓고 있는 질환|1\.\s*카페인 섭취에 관한 질문)\b"
PERSON_MORE = r"(주민등록|교육:|결혼:|하루 평균 근무시간|시\s*\d+분부터|교대 근무를 합니까|만약 예라면|신장:|체중:|kg/m²|cm\b|kg\b|sex:|age:|date:|psg#:|body mass index|neck circumference)"
PERSON_AHEAD = 4
TITLE_CATEGORY = {"MQ": "mq", "SSS": "sss", "ESS": "ess", "FSS": "fss", "BQ": "berlin", "ISI": "isi", "RLS": "rls", "IRLS": "rls", "RBD": "rbd", "PHQ": "phq", "PSQI": "psqi", "BDI": "bdi", "QOL": "qol"}
ITEM = r"^\s*\d+[.)]|\|\s*항목|selected!|not selected"
# Cues worth two more hits where leftover lines are assigned.
STRONG = {"psg": r"(report|result|diagnosis|conclusion|study date|test no\.|수면검사)", "cpap": r"(cpap|pap|pressure\s+\d+\s*cmh2o|optimal cpap pressure)", "mq": "(아침 질문 사항|어젯밤|오늘 아침)"}
LEAST_COVERED = 0.75
SPLIT_PAGES, SPLIT_CHARS = 7, 8000
PAGE_NUMBER, DECORATION = r"^[-\s]*(?:page\s*)?\d+(?:\s*/\s*\d+)?[-\s]*$", r"^[\s|\-_~=·•*#.:]+$"


def informative(line: str | Column) -> Column:
    """Not blank, not a page marker, not a page number alone, not decoration."""
    t = F.trim(line)
    return (t != "") & ~t.rlike(MARKER) & ~t.rlike(f"(?i){PAGE_NUMBER}") & ~t.rlike(DECORATION)


def _after(flag: Column, keys: list[str]) -> Column:
    """The least line number after this one whose flag holds."""
    w = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(1, Window.unboundedFollowing)
    return F.min(F.when(flag, F.col("line_no"))).over(w)


def _last(keys: list[str]) -> Column:
    return F.max("line_no").over(Window.partitionBy(*keys))


def to_end(lines: DataFrame, keys: list[str], anchor: Column, stop: Column, category: str) -> DataFrame:
    """Ranges from each anchor line to the line before the next stop, coalesced."""
    rows = lines.withColumns({"__stop": _after(stop, keys), "__end": _last(keys)}).where(anchor)
    found = rows.select(*keys, F.lit(category).alias("category"), F.col("line_no").alias("lo"), F.coalesce(F.col("__stop") - 1, F.col("__end")).alias("hi"))
    return intervals.coalesce_ranges(found, [*keys, "category"], "lo", "hi")


def morning_ranges(lines: DataFrame, keys: list[str]) -> DataFrame:
    return to_end(lines, keys, F.contains("line", F.lit(MORNING_TITLE)), F.col("line").rlike(MARKER), "mq")


def question_ranges(lines: DataFrame, keys: list[str], category: str, numbers: tuple[int, ...] = (), patterns: tuple[str, ...] = ()) -> DataFrame:
    """From a wanted question or pattern to a marker or the next question; from a pattern also to a blank line."""
    question = F.col("line").rlike(NUMBERED)
    wanted = F.regexp_extract("line", NUMBERED, 1).try_cast("int").isin(*numbers) if numbers else F.lit(False)
    stop = F.col("line").rlike(MARKER) | question
    asked = to_end(lines, keys, question & wanted, stop, category)
    said = to_end(lines, keys, holds("line", *patterns) & ~(question & wanted), stop | (F.trim("line") == ""), category) if patterns else asked.limit(0)
    return intervals.coalesce_ranges(asked.unionByName(said), [*keys, "category"], "lo", "hi")


def checklist_ranges(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of ticked symptoms, for no use."""
    hit = lines.where(holds("line", *[rf"^\s*(?:L\d+\s*\|\s*)?{w}{TICKED}" for w in CHECKLIST]))
    return intervals.islands(hit, keys, "line_no").select(*keys, F.lit("not_used").alias("category"), F.col("start").alias("lo"), F.col("end").alias("hi"))


def history_ranges(lines: DataFrame, keys: list[str]) -> DataFrame:
    """From the ninth question, if it stands within the lines before an anchor, to a marker or the fourteenth."""
    back = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(1 - HISTORY_BACK, 0)
    first = F.max(F.when(F.col("line").rlike(HISTORY_FIRST), F.col("line_no"))).over(back)
    stop = _after(F.col("line").rlike(MARKER) | F.col("line").rlike(HISTORY_AFTER), keys)
    rows = lines.withColumns({"__first": first, "__stop": stop, "__end": _last(keys)}).where(holds("line", *SLEEP_HISTORY))
    found = rows.select(*keys, F.lit("sleep_behavior").alias("category"), F.coalesce("__first", "line_no").alias("lo"), F.coalesce(F.col("__stop") - 1, F.col("__end")).alias("hi"))
    return intervals.coalesce_ranges(found, [*keys, "category"], "lo", "hi")


def person_ranges(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines that name a person's data, each with up to PERSON_AHEAD more that go on with it (blank ones too) until one that doesn't."""
    w = Window.partitionBy(*keys).orderBy("line_no")
    anchor = holds("line", *CATEGORIES["basic"])
    stop = F.col("line").rlike(MARKER) | holds("line", PERSON_STOP)
    more = ~stop & ((F.trim("line") == "") | holds("line", PERSON_MORE) | anchor)
    rows = lines.withColumns({"__a": anchor, "__more": more})
    taken = F.col("__a")
    goes = F.col("__more")
    for k in range(1, PERSON_AHEAD + 1):  # the k-th line after an anchor, when all between go on
        taken = taken | (goes & F.coalesce(F.lag("__a", k).over(w), F.lit(False)))
        goes = goes & F.coalesce(F.lag("__more", k).over(w), F.lit(False))
    hit = rows.withColumn("__t", taken).where("__t")
    return intervals.islands(hit, keys, "line_no").select(*keys, F.lit("basic").alias("category"), F.col("start").alias("lo"), F.col("end").alias("hi"))


def titled(lines: DataFrame) -> DataFrame:
    """`lines` with title: the category of the official form whose title the line holds."""
    return lines.withColumn("title", ordered([(holds("line", *titles), TITLE_CATEGORY[name]) for name, titles in FAMILIES.items()], None))


def expanded(ranges: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """`ranges`, those of official forms that hold a title only also from it to the next title, marker or break.

    A range is a title only if its first informative line is its category's title and it has at most two such lines, or four without an item.
    """
    full = titled(lines).withColumn("__inf", informative("line"))
    full = full.withColumns({"__stop": _after(F.col("title").isNotNull() | F.col("line").rlike(MARKER) | holds("line", *BREAKS), keys), "__end": _last(keys)})
    r = ranges.where(F.col("category").isin(*set(TITLE_CATEGORY.values())))
    # each line meets its own document's ranges; a document's ranges don't overlap much
    inside = full.join(r, keys).where("line_no between lo and hi")
    own = F.col("title") == F.col("category")
    seen = inside.groupBy(*keys, "category", "lo", "hi").agg(
        F.count_if("__inf").alias("__n"), F.min_by(F.coalesce(own, F.lit(False)), F.when(F.col("__inf"), F.col("line_no"))).alias("__first"),
        (F.count_if(F.col("__inf") & F.col("line").rlike(f"(?i){ITEM}")) - F.count_if(F.col("__inf") & F.col("line").rlike(f"(?i){ITEM}") & own)).alias("__items"),
        F.min(F.when(own, F.struct("line_no", F.coalesce(F.col("__stop") - 1, F.col("__end")).alias("to")))).alias("__t"),
    )
    more = seen.where("__first and __t is not null and (__n <= 2 or (__n <= 4 and __items = 0))").select(*keys, "category", F.col("__t.line_no").alias("lo"), F.greatest("__t.line_no", "__t.to").alias("hi"))
    return intervals.coalesce_ranges(ranges.select(*keys, "category", "lo", "hi").unionByName(more), [*keys, "category"], "lo", "hi")


def _minus(ranges: DataFrame, keys: list[str], of: tuple[str, ...], minus: DataFrame) -> DataFrame:
    """`ranges` where those of the categories `of` lose what `minus` (keys, category, lo, hi) covers."""
    mine = ranges.where(F.col("category").isin(*of))
    cut = intervals.subtract_ranges(mine, minus, [*keys, "category"], "lo", "hi")
    return ranges.where(~F.col("category").isin(*of)).select(*keys, "category", "lo", "hi").unionByName(cut.select(*keys, "category", "lo", "hi"))


def _as(ranges: DataFrame, keys: list[str], *names: str) -> DataFrame:
    return ranges.select(*keys, F.explode(F.array(*map(F.lit, names))).alias("category"), "lo", "hi")


def finalised(ranges: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """The ranges repaired: titles expanded; what rules find of the person, the morning form, dreams, symptoms and sleep history added;
    ticked checklists set aside; then habits lose what any other category has, sleep behaviour what others but the person have, and the person what any other has.
    """
    key = [*keys, "category"]
    join = lambda *parts: intervals.coalesce_ranges(_union(parts, keys), key, "lo", "hi")
    r = expanded(ranges, lines, keys)
    dreams = question_ranges(lines, keys, "rbd", patterns=DREAMS)
    morning = morning_ranges(lines, keys)
    # dreams stand where the rules find them, and nowhere else
    r = join(r.where("category <> 'rbd'"), dreams, person_ranges(lines, keys), morning)
    r = _minus(r, keys, ("phx_habit", "sleep_behavior"), _as(morning, keys, "phx_habit", "sleep_behavior"))
    r = join(r, checklist_ranges(lines, keys), question_ranges(lines, keys, "sleep_behavior", patterns=SYMPTOMS), history_ranges(lines, keys))
    for name, kept in (("phx_habit", ("phx_habit",)), ("sleep_behavior", ("sleep_behavior", "basic")), ("basic", ("basic",))):
        r = _minus(r, keys, (name,), _as(r.where(~F.col("category").isin(*kept)), keys, name))
    return r


def _union(parts: tuple[DataFrame, ...], keys: list[str]) -> DataFrame:
    out = None
    for p in parts:
        p = p.select(*keys, "category", "lo", "hi")
        out = p if out is None else out.unionByName(p)
    return out


def leftover(lines: DataFrame, ranges: DataFrame, keys: list[str], weighty: Column | None = None) -> DataFrame:
    """Rows (keys, lo, hi): runs of informative lines (or of those that `weighty` holds for) that no range covers."""
    points = lines.where(informative("line") if weighty is None else weighty).select(*keys, "line_no")
    return intervals.islands(intervals.uncovered(points, ranges, keys, "line_no", "lo", "hi"), keys, "line_no").select(*keys, F.col("start").alias("lo"), F.col("end").alias("hi"))


def text_of(lines: DataFrame, ranges: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Rows (keys, by, text): the lines of the ranges in order, without markers, at most one blank line between others."""
    rows = lines.join(ranges, keys).where("line_no between lo and hi").where(~F.col("line").rlike(MARKER)).select(*keys, *by, "line_no", "line").distinct()
    w = Window.partitionBy(*keys, *by).orderBy("line_no")
    blank = F.trim("line") == ""
    rows = rows.withColumn("__b", blank).withColumn("__p", F.lag("__b").over(w)).where("not (__b and coalesce(__p, true))")
    part = F.struct("line_no", F.when(F.col("__b"), "").otherwise(F.col("line")).alias("t"))
    text = F.regexp_replace(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda s: s["t"]), "\n"), r"^\s+|\s+\z", "")
    return rows.groupBy(*keys, *by).agg(text.alias("text")).where("text <> ''")


def best_categories(lines: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, lo, hi, category): each leftover run's category by patterns found in its text, two more for strong cues, the first of equals."""
    titles: dict[str, tuple[str, ...]] = {}
    for name, own in FAMILIES.items():
        titles[TITLE_CATEGORY[name]] = titles.get(TITLE_CATEGORY[name], ()) + own
    patterns = {name: own + titles.get(name, ()) + (DREAMS if name == "rbd" else ()) for name, own in CATEGORIES.items()}
    texts = text_of(lines, spans, keys, ["lo", "hi"])
    hit = lambda p: holds("text", p).cast("int")
    score = {name: sum((hit(p) for p in dict.fromkeys(own)), F.lit(0)) + (2 * hit(STRONG[name]) if name in STRONG else F.lit(0)) for name, own in patterns.items()}
    best = F.array_sort(F.array(*[F.struct((-s).alias("s"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, s) in enumerate(score.items())]))[0]
    return texts.select(*keys, "lo", "hi", best["n"].alias("category"))


def coverage(lines: DataFrame, ranges: DataFrame, keys: list[str], weighty: Column | None = None) -> DataFrame:
    """Rows (keys, informative, covered, share, outside, valid): how many informative lines (or of those that `weighty` holds for) the ranges
    cover, and whether any range leaves the document. Lines are counted one by one, so lines of a number that repeats all count."""
    w = informative("line") if weighty is None else weighty
    points = lines.select(*keys, "line_no", F.coalesce(w, F.lit(False)).alias("__w"))
    marked = intervals.marked(points, ranges, keys, "line_no", "lo", "hi", "__in")
    last = marked.groupBy(*keys).agg(F.max("line_no").alias("__last"), F.count_if("__w").alias("informative"), F.count_if(F.col("__w") & F.col("__in")).alias("covered"))
    out = ranges.join(last, keys).groupBy(*keys).agg(F.count_if((F.col("lo") < 1) | (F.col("hi") > F.col("__last"))).alias("outside"))
    share = F.coalesce(F.try_divide("covered", "informative"), F.lit(1.0))
    outside = F.coalesce("outside", F.lit(0))
    return last.join(out, keys, "left").select(*keys, "informative", "covered", share.alias("share"), outside.alias("outside"), ((outside == 0) & (share >= LEAST_COVERED)).alias("valid"))


def missing_lines(parts: DataFrame, merged: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, category, line): lines of category texts that the document's text doesn't hold; short ones don't count."""
    rows = parts.select(*keys, "category", F.explode(F.split("text", r"\r\n|\n|\r")).alias("line")).withColumn("line", F.trim("line"))
    weighty = (F.length("line") >= 8) | ((F.length("line") >= 4) & F.col("line").rlike("[A-Za-z가-힣]"))
    return rows.where(weighty & ~F.col("line").rlike(MARKER)).join(merged.select(*keys, F.col("text").alias("__text")), keys).where(~F.contains("__text", F.col("line"))).drop("__text")


def page_offsets(pages: DataFrame, keys: list[str], page: str, n_lines: str) -> DataFrame:
    """`pages` with first and last: where each page's lines stand in the merged text, one separator line between pages."""
    before = F.coalesce(F.sum(F.col(n_lines) + 1).over(Window.partitionBy(*keys).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return pages.withColumn("first", before + 1).withColumn("last", before + F.col(n_lines))


def in_two(pages: Column, chars: Column) -> Column:
    """Whether a document is split as two bundles."""
    return (pages > SPLIT_PAGES) & (chars >= SPLIT_CHARS)


def halves(text: str | Column) -> Column:
    """A long report as two texts with the same head: a sixth of its lines, 4 to 12; short ones stay whole."""
    t = F.regexp_replace(text, r"^\s+|\s+\z", "")
    lines = F.split(t, r"\r\n|\n|\r")
    n = F.size(lines)
    head = F.least(F.lit(12), F.greatest(F.lit(4), F.floor(n / 6))).cast("int")
    body = n - head
    middle = F.floor(body / 2).cast("int")
    part = lambda a, k: F.array_join(F.concat(F.slice(lines, F.lit(1), head), F.slice(lines, a, k)), "\n")
    return F.when((n >= 20) & (body >= 10), F.array(part(head + 1, middle), part(head + middle + 1, body - middle))).otherwise(F.array(t))


def ticked_items(text: str | Column) -> Column:
    """The items of a checklist, each from its [Yes] or [No] on."""
    plain = F.trim(F.regexp_replace(text, r"\s+", " "))
    items = F.regexp_extract_all(plain, F.lit(r"(?i)(\[(?:Yes|No)\].*?)(?=\[(?:Yes|No)\]|$)"), F.lit(1))
    return F.filter(F.transform(items, lambda x: F.regexp_replace(x, r"[ ,;)]+$", "")), lambda x: x != "")


def marks(text: str | Column, trigger: str, expected: int = 28) -> Column:
    """struct(yes, no, complete): a page with the trigger is complete with as many marks as expected, any other always."""
    yes, no = (F.regexp_count(text, F.lit(rf"(?i)\[{w}\]")) for w in ("Yes", "No"))
    return F.struct(yes.alias("yes"), no.alias("no"), (~F.contains(F.col(text) if isinstance(text, str) else text, F.lit(trigger)) | (yes + no == expected)).alias("complete"))


def pages_by_category(pages: DataFrame, entity: str, page: str, body: str, named: str) -> DataFrame:
    """Rows (entity, category, text): each category's pages merged in order; a page stands under all of its categories."""
    rows = pages.withColumn("category", F.explode(named)).withColumn("__e", F.struct(F.col(entity).alias("e"), F.col("category").alias("c")))
    return text.merged_pages(rows, "__e", page, body).select(F.col("__e.e").alias(entity), F.col("__e.c").alias("category"), "text")
