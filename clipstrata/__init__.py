"""Spark-native analytics for frame-ordered clips and the text about them."""
