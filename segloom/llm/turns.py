"""Speaker turns from transcript segments.

Labels are normalised to the speakers of the video that they may name, segments
without speech are set aside, and a gradient-boosted classifier decides for each
labelled segment whether a turn ends before it: from how near its label is to
the speaker before and to any other, from gap, overlap and context. It learns
from labels that are certain, of which it is shown damaged or shared forms.
Order within a video is handled in buckets of time, so that a video with a third
of all rows is no single task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.functions import timecode as tc
from segloom.functions.binding import let
from segloom.llm.fillers import Fillers, clean_texts, holds_speech, language_of, learn_fillers
from segloom.llm.speakers import FAR, aliases, content_label, label_key, near_forms, nearest_two
from segloom.operators.ordered import previous_value
from segloom.operators.segments import start_ms
from segloom.session import materialize

#: Bucket of time in which a video's segments are ordered: 2**21 ms, about 35 minutes.
BUCKET_BITS = 21
FEATURES = ("same_label", "numbered", "edits_prior", "edits_other", "gap_s", "overlap", "same_language", "words", "previous_words", "question_before")
_FIRST = ("first_no", "first_edits", "second_no", "second_edits")


def spoken_segments(segments: DataFrame, speakers: DataFrame, fillers: Fillers = Fillers()) -> DataFrame:
    """The segments with speech and a start, with the speakers that their labels may name.

    ``key`` is the label's key, null where nobody is named. ``first_no`` is the
    speaker nearest to it and ``second_no`` the next, each with its edits; both
    are null where the label is near nobody. ``certain`` tells that the label is
    a form of one speaker alone, ``speaker_no`` is the first where it is nearer
    than the second. Deliveries of the same segment stay; they are neighbours in
    the order and name the same speaker.
    """
    named = lambda own: F.coalesce(own, F.when(own.isNull(), label_key(content_label(F.col("content")))))
    language = language_of(F.col("language"))
    read = segments.select(
        "segment_id",
        "video_id",
        start_ms().alias("start_ms"),
        tc.parse_ms(F.col("end_time")).alias("end_ms"),
        language.alias("language"),
        F.size(F.split("content", " ")).alias("words"),
        F.coalesce(F.rtrim("content").endswith("?"), F.lit(False)).alias("asks"),
        let(label_key(F.col("speaker")), named).alias("key"),
        holds_speech(F.col("content"), fillers, language).alias("speech"),
    )
    # Written before it is filtered: a filter above would evaluate the patterns again.
    read = materialize(read, "spoken").where("speech and start_ms is not null and segment_id is not null").drop("speech")
    read = read.withColumn("bucket", F.shiftright("start_ms", BUCKET_BITS))
    numbered = F.col("key").startswith("#")
    names = materialize(read.where(F.col("key").isNotNull() & ~numbered).select("video_id", "key").distinct(), "names")
    labelled = read.where(F.col("key").isNotNull() & ~numbered).join(label_table(names, aliases(speakers)).hint("merge"), ["video_id", "key"], "left")
    plain = read.where(F.col("key").isNull() | numbered).withColumns({"first_no": F.substring("key", 2, 12).try_cast("int"), **{c: F.lit(None).cast("int") for c in _FIRST[2:]}})
    plain = plain.withColumns({"first_edits": F.when(F.col("first_no").isNotNull(), F.lit(0)), "certain": F.col("first_no").isNotNull()})
    every = plain.unionByName(labelled.withColumn("certain", F.coalesce("certain", F.lit(False))))
    return every.withColumn("speaker_no", F.when(F.col("second_no").isNull() | (F.col("first_edits") < F.col("second_edits")), F.col("first_no")))


def label_table(names: DataFrame, forms: DataFrame) -> DataFrame:
    """The distinct (video_id, key) of ``names`` with the two speakers nearest to each, and whether it is a form of one alone.

    Only keys that are no speaker's own form are compared letter by letter. The
    joins are no broadcasts: the files of such tables are a small part of their
    size in the driver's memory.
    """
    known = names.join(forms.hint("merge"), ["video_id", "key"]).groupBy("video_id", "key").agg(F.min("speaker_no").alias("first_no"), F.max("speaker_no").alias("other"))
    known = materialize(known.where("first_no = other").drop("other"), "known")
    rest = names.join(known.hint("merge"), ["video_id", "key"], "left_anti")
    open_labels = nearest_two(near_forms(rest, forms)).withColumn("certain", F.lit(False))
    null = F.lit(None).cast("int")
    certain = known.withColumns({"first_edits": F.lit(0), "second_no": null, "second_edits": null, "certain": F.lit(True)})
    return certain.unionByName(open_labels)


def adjacent_pairs(spoken: DataFrame) -> DataFrame:
    """Each spoken segment with the last speaker and label known before it in its video, and what is seen of the pair.

    What is seen of the segment before is zero at a bucket's first segment; the
    speaker and label before are carried from bucket to bucket.
    """
    order = Window.partitionBy("video_id", "bucket").orderBy("start_ms", "segment_id")
    pairs = previous_value(spoken, "video_id", "bucket", ["start_ms", "segment_id"], {"prior_speaker": F.col("speaker_no"), "prior_key": F.when(F.col("speaker_no").isNotNull(), F.col("key"))})
    before = lambda c: F.lag(c).over(order)
    pairs = pairs.withColumns({"prior_end": before("end_ms"), "prior_language": before("language"), "prior_words": before("words"), "prior_asks": before("asks")})
    gap = (F.col("start_ms") - F.col("prior_end")) / 1000.0
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    return pairs.select(
        *("segment_id", "video_id", "start_ms", "bucket", "key", "certain", "speaker_no", *_FIRST, "prior_speaker"),
        number(F.col("key") == F.col("prior_key")).alias("same_label"),
        number(F.col("key").startswith("#")).alias("numbered"),
        F.least(F.greatest(number(gap), F.lit(-60.0)), F.lit(600.0)).alias("gap_s"),
        number(gap < 0).alias("overlap"),
        number(F.col("language") == F.col("prior_language")).alias("same_language"),
        number(F.col("words")).alias("words"),
        number(F.col("prior_words")).alias("previous_words"),
        number(F.col("prior_asks")).alias("question_before"),
    )


def label_distances(pairs: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """Add ``edits_prior`` and ``edits_other``: how far the label is from the speaker before and from the nearest other one.

    ``near`` (``near_forms``) is asked where the speaker before is neither of the two nearest.
    """
    prior = F.col("prior_speaker")
    own = F.when(F.col("first_no") == prior, F.col("first_edits")).when(F.col("second_no") == prior, F.col("second_edits"))
    if near is not None:
        further = near.select("video_id", "key", F.col("speaker_no").alias("prior_speaker"), F.col("edits").alias("__edits"))
        pairs = pairs.join(further, ["video_id", "key", "prior_speaker"], "left")
        own = F.coalesce(own, F.col("__edits"))
    other = F.when(F.col("first_no") == prior, F.col("second_edits")).otherwise(F.col("first_edits"))
    edits = lambda c: F.coalesce(c, F.lit(FAR)).cast("double")
    return pairs.withColumns({"edits_prior": edits(own), "edits_other": edits(other)}).drop("__edits")


def _damaged(key: Column, seed: Column) -> Column:
    """A label with one to three letters changed, dropped or doubled, chosen by ``seed``."""

    def once(n: int) -> Callable[[Column], Column]:
        def changed(text: Column) -> Column:
            roll = F.xxhash64(seed, F.lit(n))
            at = F.pmod(roll, F.length(text)).cast("int") + 1
            letter = F.substring(F.lit("aeinrstloumdchg"), F.pmod(F.shiftright(roll, 8), F.lit(15)).cast("int") + 1, F.lit(1))
            put = F.when(F.pmod(F.shiftright(roll, 16), F.lit(3)) > 0, F.repeat(letter, F.pmod(F.shiftright(roll, 16), F.lit(3)).cast("int"))).otherwise(F.lit(""))
            cut = F.concat(F.substring(text, F.lit(1), at - 1), put, F.substring(text, at + 1, F.length(text)))
            return F.when((F.pmod(seed, F.lit(3)) >= n) & (F.length(text) > 1), cut).otherwise(text)

        return changed

    return let(let(let(key, once(0)), once(1)), once(2))


def training_pairs(spoken: DataFrame, forms: DataFrame, total: int, bound: int = 20_000) -> DataFrame:
    """At most ``bound`` pairs of certain labels, as they would look with worse ones: features, ``label`` and ``by_rule``.

    They come from buckets of time chosen by a hash. Of the labels a quarter
    stays, half are damaged in one to three letters, and a quarter looks like
    one that both speakers share. ``label`` is 1 where the speakers differ;
    ``by_rule`` is what normalising the worse label alone would say: a change
    where it is nearest to another speaker.
    """
    share = min(1.0, bound / max(1, total))
    buckets = spoken.where(F.pmod(F.xxhash64("video_id", "bucket"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    known = adjacent_pairs(buckets).where("certain and prior_speaker is not null").limit(bound)
    roll = F.xxhash64("segment_id", F.lit(5))
    view = F.pmod(roll, F.lit(4))
    worse = F.when((view < 2) & (F.col("numbered") == 0) & (F.length("key") >= 4), _damaged(F.col("key"), F.shiftright(roll, 2)))
    known = known.withColumns({"label": (F.col("speaker_no") != F.col("prior_speaker")).cast("double"), "worse": worse, "shared": (view == 2) | (view < 2) & worse.isNull()})
    known = materialize(known.withColumnRenamed("key", "true_key"), "certain")
    near = materialize(near_forms(known.where("worse is not null").select("video_id", F.col("worse").alias("key")).distinct(), forms), "near")
    damaged = known.where("worse is not null").withColumn("key", F.col("worse")).drop(*_FIRST).join(nearest_two(near), ["video_id", "key"], "left")
    damaged = label_distances(damaged, near).withColumn("same_label", F.lit(0.0))
    intact = label_distances(known.where("worse is null").withColumn("key", F.col("true_key")))
    hidden = F.col("shared")
    intact = intact.withColumns({"same_label": F.when(hidden, F.lit(0.0)).otherwise(F.col("same_label")), "numbered": F.when(hidden, F.lit(0.0)).otherwise(F.col("numbered")), **{c: F.when(hidden, F.lit(0.0)).otherwise(F.col(c)) for c in ("edits_prior", "edits_other")}})
    rule = (F.col("edits_other") < F.col("edits_prior")).cast("double").alias("by_rule")
    columns = ("segment_id", "label", rule, *FEATURES)
    return damaged.select(*columns).unionByName(intact.select(*columns))


def fit_boundary(pairs: DataFrame, rounds: int = 6, depth: int = 3) -> Model | None:
    """A gradient-boosted classifier of ``training_pairs``: does a turn end before this segment? None where there is nothing to fit."""
    if pairs.select("label").distinct().count() < 2:
        return None
    inputs = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    return GBTClassifier(maxIter=rounds, maxDepth=depth, seed=7).fit(inputs.transform(pairs))


def boundary_chance(pairs: DataFrame, model: Model | None) -> DataFrame:
    """Add ``p_boundary``; without a model it is 1 where the label is nearer to another speaker."""
    if model is None:
        return pairs.withColumn("p_boundary", (F.col("edits_other") < F.col("edits_prior")).cast("double"))
    inputs = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    return model.transform(inputs.transform(pairs)).withColumn("p_boundary", vector_to_array("probability")[1])


def turn_starts(segments: DataFrame, speakers: DataFrame, fillers: Fillers | None = None) -> DataFrame:
    """One row a turn: video_id, first_segment_id, speaker_no, start_ms.

    A turn is a longest run of a video's segments with speech, in order of
    their start, that one speaker speaks. Each segment whose label is near some
    speaker is decided by the classifier: it goes on with the speaker before it,
    or is spoken by the nearest other one. A segment that names nobody, or a
    name that is near no speaker of the video, goes on with the speaker before
    it; at the video's beginning it belongs to the first speaker known.
    Segments without an id, a start or speech are left out; a video that names
    no speaker has no turns. Repeated deliveries count once; null texts and
    empty tables give no rows; further columns are ignored.
    """
    fillers = fillers if fillers is not None else learn_fillers(segments)
    spoken = materialize(spoken_segments(segments, speakers, fillers), "labelled")
    forms = materialize(aliases(speakers), "forms")
    model = fit_boundary(materialize(training_pairs(spoken, forms, segments.count()), "training"))
    pairs = materialize(adjacent_pairs(spoken).where("first_no is not null"), "pairs")
    far = F.col("certain") | F.col("prior_speaker").isNull() | F.col("prior_speaker").isin(F.col("first_no"), F.col("second_no"))
    doubtful = pairs.where(~F.coalesce(far, F.lit(False)))
    near = near_forms(doubtful.select("video_id", "key").distinct(), forms)
    seen = label_distances(pairs.where(F.coalesce(far, F.lit(False)))).unionByName(label_distances(doubtful, near), allowMissingColumns=True)
    other = F.when(F.col("first_no") == F.col("prior_speaker"), F.col("second_no")).otherwise(F.col("first_no"))
    speaker = F.when(F.col("prior_speaker").isNull(), F.col("first_no")).when(F.col("p_boundary") >= 0.5, F.coalesce(other, "prior_speaker")).otherwise(F.col("prior_speaker"))
    decided = boundary_chance(seen, model).select("video_id", "bucket", "start_ms", "segment_id", speaker.alias("speaker_no"))
    held = previous_value(materialize(decided, "decided"), "video_id", "bucket", ["start_ms", "segment_id"], {"before": F.col("speaker_no")})
    starts = held.where("before is null or before <> speaker_no")
    # The first speaker known may speak some unnamed segments before: the turn begins at the video's first segment.
    opening = spoken.groupBy("video_id").agg(F.min_by("segment_id", F.struct("start_ms", "segment_id")).alias("opening_id"), F.min("start_ms").alias("opening_ms"))
    first = starts.where("before is null").join(opening, "video_id").select("video_id", F.col("opening_id").alias("first_segment_id"), "speaker_no", F.col("opening_ms").alias("start_ms"))
    later = starts.where("before is not null").select("video_id", F.col("segment_id").alias("first_segment_id"), "speaker_no", "start_ms")
    return first.unionByName(later)


def clean_turns(segments: DataFrame, speakers: DataFrame) -> DataFrame:
    """The turns in spoken order with their clean pieces of text.

    One row a segment with speech: video_id, turn_id (the turn's first
    segment), speaker_no, start_ms, segment_id, text. The text is free of
    labels, times, annotations and fillers. A turn's text is its rows' texts in
    order of start; they stay rows, so that no turn has to fit one value. The
    cases are those of ``turn_starts``.
    """
    fillers = learn_fillers(segments)
    starts = turn_starts(segments, speakers, fillers).select("video_id", "start_ms", F.col("first_segment_id").alias("segment_id"), F.struct("first_segment_id", "speaker_no").alias("turn"))
    starts = materialize(starts, "starts")
    once = segments.where("segment_id is not null").dropDuplicates(["segment_id"])
    timed = once.select("video_id", "segment_id", start_ms().alias("start_ms"), "content", "language").where("start_ms is not null")
    texts = clean_texts(timed, "segment_id", "content", "language", fillers).where("text rlike '[\\\\p{L}\\\\p{N}]'")
    texts = texts.select("video_id", "segment_id", "start_ms", "text", F.lit(None).cast("struct<first_segment_id:bigint,speaker_no:int>").alias("turn"))
    # A turn's start comes just before its first segment.
    marks = starts.select("video_id", "segment_id", "start_ms", F.lit("").alias("text"), "turn").withColumn("kind", F.lit(0))
    rows = materialize(marks.unionByName(texts.withColumn("kind", F.lit(1))).withColumn("bucket", F.shiftright("start_ms", BUCKET_BITS)), "marked")
    held = previous_value(rows, "video_id", "bucket", ["start_ms", "segment_id", "kind"], {"held": F.col("turn")})
    return held.where("kind = 1 and held is not null").select("video_id", F.col("held.first_segment_id").alias("turn_id"), "held.speaker_no", "start_ms", "segment_id", "text")
