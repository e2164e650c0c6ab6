"""Input schemas and the fixed values the results depend on."""

from pyspark.sql import types as T

TWEET = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("label", T.LongType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("tweet", T.StringType()),
    T.StructField("user_id", T.LongType()),
])

PREDICTION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("ml_sentiment", T.StringType()),
])

LEXICON = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("polarity", T.DoubleType()),
])

# A lexicon of words and of words that change them: a degree below 0 negates, others strengthen or weaken.
LEXICON_WITH_DEGREES = T.StructType([*LEXICON, T.StructField("degree", T.DoubleType())])

# The words counted in negative and in positive tweets.
NEGATIVE_WORDS = [
    "bad", "attack", "lost", "hate", "#rip", "aww", "empty", "dead",
    "#sad", "#anxiety", "#depressed", "#depression", "death", "#melancholy",
]
POSITIVE_WORDS = [
    "good", "love", "happy", "great", "fun", "amazing", "awesome",
    "#joy", "#win", "#success", "#motivation", "#healthy", "#love",
]

# The comment stored with each table.
TABLE_COMMENTS = {
    "tweet_data": "Bronze table: raw tweets with ML predictions",
    "valid_tweets": "Silver table: complete tweets with their predictions and lexicon polarity",
    "hourly_sentiment_trend": "Hourly sentiment trend with counts and percentages",
    "discrepant_tweets": "Tweets whose label differs from the category of their lexicon polarity",
    "negative_word_frequency": "Top negative words from negative tweets",
    "positive_word_frequency": "Top positive words from positive tweets",
    "neutral_word_frequency": "Top words from tweets categorized as neutral",
    "top_hashtags_by_sentiment": "Top hashtags per sentiment category",
    "ml_sentiment_accuracy": "Daily accuracy metrics comparing ML predictions vs ground truth",
    "ml_vs_label_comparison": "Compare ml_sentiment vs label counts for each sentiment category",
    "anomaly_log": "All discrepancies of the silver table with the time they were logged; anomaly_alert counts them",
}

# The texts of the anomaly log and of its alert.
ANOMALY_DESCRIPTION = "Discrepancy between label and sentiment"
ALERT_MESSAGE = "Anomaly Detected! %d discrepancies found in sentiment pipeline."

# A starter lexicon with polarities of our own; production runs pass their own table (see sources.lexicon).
STARTER_LEXICON = {
    "amazing": 0.8, "anxiety": -0.5, "attack": -0.5, "awesome": 0.9, "bad": -0.7, "dead": -0.5,
    "death": -0.5, "depressed": -0.7, "depression": -0.6, "empty": -0.2, "fun": 0.4, "good": 0.7,
    "great": 0.8, "happy": 0.8, "hate": -0.8, "healthy": 0.5, "joy": 0.8, "lost": -0.1,
    "love": 0.5, "melancholy": -0.4, "motivation": 0.3, "sad": -0.5, "success": 0.4, "thanks": 0.2,
    "win": 0.8,
}

# Starter negations and degree words, with degrees of our own. "t" is what a word like "isn't" ends in.
STARTER_DEGREES = {
    "absolutely": 1.4, "almost": 0.8, "barely": 0.5, "extremely": 1.5, "hardly": -0.3, "never": -0.5, "no": -0.5,
    "not": -0.5, "quite": 1.1, "really": 1.3, "slightly": 0.5, "so": 1.2, "somewhat": 0.7, "t": -0.5, "too": 1.2,
    "totally": 1.4, "very": 1.3, "without": -0.5,
}
