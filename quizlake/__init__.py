"""quizlake: a PySpark-native analytics toolkit for quiz-tournament data."""
