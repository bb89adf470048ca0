"""Language labels: naive Bayes over words and word ends, kept as tables of counts, and names."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.functions.base import bind
from duskwatch.session import materialize

# Names of two-letter language codes (ISO 639-1).
LANGUAGE_NAMES = {
    "aa": "Afar", "ab": "Abkhazian", "ae": "Avestan", "af": "Afrikaans", "ak": "Akan", "am": "Amharic",
    "an": "Aragonese", "ar": "Arabic", "as": "Assamese", "av": "Avaric", "ay": "Aymara", "az": "Azerbaijani",
    "ba": "Bashkir", "be": "Belarusian", "bg": "Bulgarian", "bi": "Bislama", "bm": "Bambara", "bn": "Bengali",
    "bo": "Tibetan", "br": "Breton", "bs": "Bosnian", "ca": "Catalan", "ce": "Chechen", "ch": "Chamorro",
    "co": "Corsican", "cr": "Cree", "cs": "Czech", "cu": "Church Slavic", "cv": "Chuvash", "cy": "Welsh",
    "da": "Danish", "de": "German", "dv": "Dhivehi", "dz": "Dzongkha", "ee": "Ewe", "el": "Modern Greek (1453-)",
    "en": "English", "eo": "Esperanto", "es": "Spanish", "et": "Estonian", "eu": "Basque", "fa": "Persian",
    "ff": "Fulah", "fi": "Finnish", "fj": "Fijian", "fo": "Faroese", "fr": "French", "fy": "Western Frisian",
    "ga": "Irish", "gd": "Scottish Gaelic", "gl": "Galician", "gn": "Guarani", "gu": "Gujarati", "gv": "Manx",
    "ha": "Hausa", "he": "Hebrew", "hi": "Hindi", "ho": "Hiri Motu", "hr": "Croatian", "ht": "Haitian",
    "hu": "Hungarian", "hy": "Armenian", "hz": "Herero",
    "ia": "Interlingua (International Auxiliary Language Association)", "id": "Indonesian", "ie": "Interlingue",
    "ig": "Igbo", "ii": "Sichuan Yi", "ik": "Inupiaq", "io": "Ido", "is": "Icelandic", "it": "Italian",
    "iu": "Inuktitut", "ja": "Japanese", "jv": "Javanese", "ka": "Georgian", "kg": "Kongo", "ki": "Kikuyu",
    "kj": "Kuanyama", "kk": "Kazakh", "kl": "Kalaallisut", "km": "Khmer", "kn": "Kannada", "ko": "Korean",
    "kr": "Kanuri", "ks": "Kashmiri", "ku": "Kurdish", "kv": "Komi", "kw": "Cornish", "ky": "Kirghiz", "la": "Latin",
    "lb": "Luxembourgish", "lg": "Ganda", "li": "Limburgan", "ln": "Lingala", "lo": "Lao", "lt": "Lithuanian",
    "lu": "Luba-Katanga", "lv": "Latvian", "mg": "Malagasy", "mh": "Marshallese", "mi": "Maori", "mk": "Macedonian",
    "ml": "Malayalam", "mn": "Mongolian", "mr": "Marathi", "ms": "Malay (macrolanguage)", "mt": "Maltese",
    "my": "Burmese", "na": "Nauru", "nb": "Norwegian Bokmål", "nd": "North Ndebele", "ne": "Nepali (macrolanguage)",
    "ng": "Ndonga", "nl": "Dutch", "nn": "Norwegian Nynorsk", "no": "Norwegian", "nr": "South Ndebele",
    "nv": "Navajo", "ny": "Nyanja", "oc": "Occitan (post 1500)", "oj": "Ojibwa", "om": "Oromo",
    "or": "Oriya (macrolanguage)", "os": "Ossetian", "pa": "Panjabi", "pi": "Pali", "pl": "Polish", "ps": "Pushto",
    "pt": "Portuguese", "qu": "Quechua", "rm": "Romansh", "rn": "Rundi", "ro": "Romanian", "ru": "Russian",
    "rw": "Kinyarwanda", "sa": "Sanskrit", "sc": "Sardinian", "sd": "Sindhi", "se": "Northern Sami", "sg": "Sango",
    "sh": "Serbo-Croatian", "si": "Sinhala", "sk": "Slovak", "sl": "Slovenian", "sm": "Samoan", "sn": "Shona",
    "so": "Somali", "sq": "Albanian", "sr": "Serbian", "ss": "Swati", "st": "Southern Sotho", "su": "Sundanese",
    "sv": "Swedish", "sw": "Swahili (macrolanguage)", "ta": "Tamil", "te": "Telugu", "tg": "Tajik", "th": "Thai",
    "ti": "Tigrinya", "tk": "Turkmen", "tl": "Tagalog", "tn": "Tswana", "to": "Tonga (Tonga Islands)",
    "tr": "Turkish", "ts": "Tsonga", "tt": "Tatar", "tw": "Twi", "ty": "Tahitian", "ug": "Uighur", "uk": "Ukrainian",
    "ur": "Urdu", "uz": "Uzbek", "ve": "Venda", "vi": "Vietnamese", "vo": "Volapük", "wa": "Walloon", "wo": "Wolof",
    "xh": "Xhosa", "yi": "Yiddish", "yo": "Yoruba", "za": "Zhuang", "zh": "Chinese", "zu": "Zulu",
}

#: Features of a model at most. Bounds the table that scoring sends to every task.
VOCABULARY = 1 << 16
#: Weights are whole numbers of this part of a natural logarithm, so sums do not depend on their order.
UNIT = 1_000_000
#: Numbers in the sums of the distinct words that a Python worker scores at a time.
PIECE = 1 << 21
#: The feature that every text has once: its count is the number of texts.
TEXT = ""


def language_name(code: Column, names: dict[str, str] = LANGUAGE_NAMES) -> Column:
    """Name of a two-letter code; unknown codes stay as they are."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code), code)


def text_words(text: Column) -> Column:
    """Every lower-case word."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def word_ends(word: Column) -> tuple[Column, Column]:
    """First and last three letters of a word. Words hold letters only, so no word is one of these."""
    return F.concat(F.lit("^"), F.substring(word, 1, 3)), F.concat(F.substring(word, -3, 3), F.lit("$"))


def language_counts(labelled: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` of texts ``(text, lang)``; the gram :data:`TEXT` counts texts. Rows without a language are left out.

    Words are counted first; the grams are those of the distinct words, with their counts.
    """
    known = labelled.where("lang is not null").select(
        "lang", F.explode(F.concat(F.array(F.lit(TEXT)), F.coalesce(text_words(F.col("text")), F.array().cast("array<string>")))).alias("word"))
    counted = known.groupBy("lang", "word").agg(F.count("*").alias("n"))
    grams = F.when(F.col("word") == TEXT, F.array("word")).otherwise(F.array("word", *word_ends(F.col("word"))))
    return counted.select("lang", F.explode(grams).alias("gram"), "n").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def added_counts(*parts: DataFrame) -> DataFrame:
    """Counts of several days or tables as one."""
    rows = parts[0].select("lang", "gram", "n")
    for part in parts[1:]:
        rows = rows.unionByName(part.select("lang", "gram", "n"))
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    counts: DataFrame       # (lang, gram, n)
    weights: DataFrame      # (gram, w): at most VOCABULARY rows, one whole number per language
    languages: list[str]
    priors: list[int]       # logarithms of the shares of texts
    costs: list[int]        # what every known gram of a text costs, by language


def _units(value: Column) -> Column:
    return F.round(F.ln(value) * UNIT).cast("bigint")


def fit(counts: DataFrame, size: int = VOCABULARY) -> LanguageModel:
    """A multinomial model of the ``size`` most frequent grams, with one added to every count.

    The weight of a gram is ``ln(n + 1)``; what it lacks to a probability, ``ln(N + V)``, is the
    same for all grams of a language and counted per gram of the text. The driver sees one row
    per language.
    """
    grams = counts.where(F.col("gram") != TEXT)
    frequent = grams.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(size).select("gram")
    kept = materialize(grams.join(F.broadcast(frequent), "gram"), "language_grams")
    vocabulary = kept.select("gram").distinct().count()
    texts = counts.where(F.col("gram") == TEXT).select("lang", F.col("n").alias("texts"))
    totals = kept.groupBy("lang").agg(F.sum("n").alias("total"))
    total_texts = texts.agg(F.sum("texts").alias("all"))  # one row
    found = texts.join(totals, "lang", "left").join(F.broadcast(total_texts)).select(
        "lang", _units(F.col("texts") / F.col("all")).alias("prior"),
        _units(F.coalesce("total", F.lit(0)) + vocabulary).alias("cost")).orderBy("lang").collect()
    languages = [r["lang"] for r in found]
    weight = [F.max(F.when(F.col("lang") == name, _units(F.col("n") + 1)).otherwise(0)) for name in languages]
    weights = kept.groupBy("gram").agg(F.array(*weight).alias("w")) if languages else kept.select(
        "gram", F.array().cast("array<bigint>").alias("w"))
    return LanguageModel(
        counts, materialize(weights, "language_weights"), languages, [r["prior"] for r in found], [r["cost"] or 0 for r in found])


def train(labelled: DataFrame, size: int = VOCABULARY) -> LanguageModel:
    """Count and fit once on ``(text, lang)``; the model is applied to whole tables."""
    return fit(materialize(language_counts(labelled), "language_counts"), size)


def _sums_udf(model: LanguageModel):
    # Plain values only: the function travels to executors that need not have this package.
    size = len(model.languages)
    piece = max(PIECE // (size + 1), 1)
    rows = model.weights.toArrow()  # bounded by VOCABULARY
    weights = np.zeros((len(rows) + 1, size + 1), dtype=np.int64)  # known grams, then languages; zeros for an unknown one
    weights[:-1, 0] = 1
    if size:
        weights[:-1, 1:] = rows["w"].combine_chunks().flatten().to_numpy().reshape(-1, size)
    sent = model.weights.sparkSession.sparkContext.broadcast((rows["gram"].combine_chunks().cast(pa.string()), weights))

    @F.arrow_udf("array<bigint>")
    def sums(words: pa.Array) -> pa.Array:
        known, weights = sent.value
        lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        flat = words.flatten()
        result = np.zeros((len(words), size + 1), dtype=np.int64)
        for start in range(0, len(flat), piece):
            coded = flat.slice(start, piece).dictionary_encode()
            distinct = coded.dictionary.cast(pa.string())
            first = pc.binary_join_element_wise("^", pc.utf8_slice_codeunits(distinct, 0, 3), "")
            last = pc.binary_join_element_wise(pc.utf8_slice_codeunits(distinct, -3), "$", "")
            values = sum(weights.take(pc.fill_null(pc.index_in(grams, known), len(known)).to_numpy(), axis=0)
                         for grams in (distinct, first, last))
            codes = coded.indices.to_numpy()
            end = start + len(codes)
            row = int(np.searchsorted(bounds, start, "right")) - 1
            while row < len(words) and bounds[row] < end:
                result[row] += values.take(codes[max(bounds[row] - start, 0):bounds[row + 1] - start], axis=0).sum(axis=0)
                row += 1
        return pa.ListArray.from_arrays(np.arange(len(words) + 1, dtype=np.int32) * (size + 1), result.ravel())

    return sums


def language_scores(model: LanguageModel, texts: DataFrame, id_col: str) -> DataFrame:
    """``(id, scores)``: per language the logarithm of its probability up to a constant, in units.

    Words are split by built-in expressions. Arrow batches are taken in pieces of bounded size: a
    distinct word of a piece meets the weights of its three grams (a table of bounded size, sent to
    all tasks) once, and a text's weights are summed before anything is shuffled. Texts without
    known grams have the priors. Rows of one id are scored as one text.
    """
    rows = texts.select(id_col, _sums_udf(model)(text_words(F.col("text"))).alias("sums"))
    sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(len(model.languages) + 1)]
    summed = rows.groupBy(id_col).agg(*sums)
    scores = [F.lit(p) + F.col(f"s{i}") - F.col("s0") * F.lit(c)
              for i, (p, c) in enumerate(zip(model.priors, model.costs, strict=True), 1)]
    return summed.select(id_col, F.array(*scores).cast("array<bigint>").alias("scores"))


def language_top2(model: LanguageModel, texts: DataFrame, id_col: str) -> DataFrame:
    """The two most probable languages of every text with their confidences."""
    best = language_scores(model, texts, id_col).select(id_col, top_k(F.col("scores"), model.languages, 2).alias("top"))
    first, second = F.get("top", F.lit(0)), F.get("top", F.lit(1))
    return best.select(
        id_col,
        language_name(first["code"]).alias("first_language"), first["p"].alias("first_confidence"),
        language_name(second["code"]).alias("second_language"), second["p"].alias("second_confidence"))


def top_k(scores: Column, labels: list[str], k: int) -> Column:
    """The ``k`` best labels with their probabilities; equal scores in order of the label."""
    codes = F.array(*[F.lit(x) for x in labels])
    most = F.array_max(scores)
    share = F.transform(scores, lambda s: F.exp((s - most) / F.lit(float(UNIT))))
    total = F.aggregate(share, F.lit(0.0), lambda a, b: a + b)
    pairs = F.transform(scores, lambda s, i: F.struct((-s).alias("rank"), F.get(codes, i).alias("code"), F.get(share, i).alias("p")))
    return bind(total, lambda t: F.transform(
        F.slice(F.array_sort(pairs), 1, k), lambda e: F.struct(e["code"].alias("code"), (e["p"] / t).alias("p"))))


def semi_english(languages: DataFrame) -> DataFrame:
    return languages.where("first_language = 'English'")


