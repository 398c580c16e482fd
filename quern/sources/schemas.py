"""Declared column types of the CSV inputs.

Fixed values: column names and types must equal those of the input files.
"""

from __future__ import annotations

MOVIES = "MovieId INT, title STRING, genres STRING"
RATINGS = "userId INT, MovieId INT, rating DOUBLE, timestamp INT"
USERS = "userId INT, foreName STRING, surName STRING, email STRING"
TAGS = "userId INT, movieId STRING, tag STRING, timestamp STRING"
XY = "X DOUBLE, Y DOUBLE"
EXAM = "ImieNazwisko STRING, OcenaC DOUBLE, DataC DATE, OcenaCpp DOUBLE, Egzamin DOUBLE"
EXAM_GRID = "ImieNazwisko STRING, OcenaC DOUBLE, DataC DATE, OcenaCpp DOUBLE"
BOOKS = "author STRING, work STRING, content STRING, content_stemmed STRING"
TWEETS = "Entity STRING, Sentiment STRING, TweetContent STRING"
