"""Constants the results depend on; all are defaults of keyword parameters."""

from __future__ import annotations

# --- Fixed values: they must equal the ones users already rely on -----------

# symbol -> sector
SYMBOL_SECTORS = {
    "AAPL": "Technology",
    "MSFT": "Technology",
    "NVDA": "Technology",
    "GOOGL": "Technology",
    "AMZN": "Technology",
    "JPM": "Finance",
    "GS": "Finance",
    "BAC": "Finance",
    "XOM": "Energy",
    "CVX": "Energy",
    "PFE": "Healthcare",
    "JNJ": "Healthcare",
    "TSLA": "Consumer",
    "WMT": "Consumer",
    "KO": "Consumer",
}

# volume category -> smallest volume, in falling order; anything below is "low"
VOLUME_LEVELS = {"very_high": 75_000_000, "high": 25_000_000, "medium": 10_000_000}

# finance phrases that move a sentiment score
BOOST_PHRASES = {
    "beats": 0.15,
    "surges": 0.15,
    "record revenue": 0.2,
    "record profits": 0.2,
    "all-time high": 0.2,
    "strong buy": 0.2,
    "upgrade": 0.15,
    "raises dividend": 0.15,
    "outperform": 0.1,
    "bullish": 0.15,
    "recall": -0.15,
    "recalls": -0.15,
    "fraud": -0.25,
    "investigation": -0.15,
    "downgrade": -0.15,
    "plunges": -0.2,
    "crashes": -0.2,
    "massive loss": -0.2,
    "earnings miss": -0.15,
    "sell rating": -0.15,
    "bearish": -0.15,
    "bankruptcy": -0.25,
    "layoffs": -0.1,
    "defects": -0.15,
}

# phrases that pull a score towards zero
DAMPENING_PHRASES = [
    "holds steady",
    "holds rates",
    "holds interest rates",
    "rates steady",
    "remains unchanged",
    "flat",
    "closed for holiday",
    "announces date",
]

# --- Word lexicon: authored for this library --------------------------------

# word -> (valence on a scale of about -4..4, polarity in -1..1)
LEXICON = {
    "strong": (2.2, 0.45),
    "stronger": (2.2, 0.4),
    "robust": (2.0, 0.4),
    "gain": (2.0, 0.4),
    "gains": (2.0, 0.4),
    "growth": (1.8, 0.3),
    "profit": (1.9, 0.4),
    "profits": (1.9, 0.4),
    "profitable": (2.0, 0.4),
    "rally": (1.7, 0.3),
    "rallies": (1.7, 0.3),
    "soars": (2.1, 0.45),
    "soar": (2.1, 0.45),
    "surge": (1.6, 0.3),
    "surged": (1.6, 0.3),
    "surges": (1.6, 0.3),
    "beat": (1.2, 0.3),
    "beats": (1.2, 0.3),
    "exceeds": (1.4, 0.3),
    "exceeded": (1.4, 0.3),
    "optimistic": (2.1, 0.5),
    "optimism": (2.1, 0.5),
    "confident": (2.2, 0.5),
    "confidence": (2.0, 0.4),
    "success": (2.7, 0.5),
    "successful": (2.7, 0.6),
    "win": (2.6, 0.6),
    "wins": (2.6, 0.6),
    "good": (1.9, 0.6),
    "great": (3.0, 0.8),
    "best": (3.1, 0.9),
    "better": (1.9, 0.5),
    "excellent": (2.8, 0.9),
    "amazing": (2.9, 0.7),
    "positive": (2.3, 0.4),
    "impressive": (2.3, 0.7),
    "innovative": (2.0, 0.4),
    "improve": (1.9, 0.3),
    "improves": (1.9, 0.3),
    "improved": (1.9, 0.3),
    "upbeat": (2.0, 0.4),
    "upgrade": (1.5, 0.3),
    "upgraded": (1.5, 0.3),
    "bullish": (1.6, 0.3),
    "boost": (1.7, 0.3),
    "boosts": (1.7, 0.3),
    "reward": (2.4, 0.4),
    "opportunity": (1.8, 0.3),
    "record": (0.8, 0.2),
    "high": (0.5, 0.16),
    "loss": (-1.6, -0.35),
    "losses": (-1.7, -0.35),
    "lose": (-1.6, -0.35),
    "loses": (-1.6, -0.35),
    "weak": (-1.9, -0.4),
    "weaker": (-1.9, -0.4),
    "weakness": (-1.8, -0.35),
    "fall": (-1.0, -0.2),
    "falls": (-1.0, -0.2),
    "drop": (-1.1, -0.2),
    "drops": (-1.1, -0.2),
    "decline": (-1.3, -0.25),
    "declines": (-1.3, -0.25),
    "plunge": (-2.0, -0.4),
    "plunges": (-2.0, -0.4),
    "plunged": (-2.0, -0.4),
    "crash": (-2.2, -0.5),
    "crashes": (-2.2, -0.5),
    "slump": (-1.8, -0.35),
    "slumps": (-1.8, -0.35),
    "miss": (-1.0, -0.25),
    "misses": (-1.0, -0.25),
    "missed": (-1.1, -0.25),
    "fraud": (-2.8, -0.6),
    "scandal": (-2.4, -0.5),
    "lawsuit": (-1.5, -0.3),
    "crisis": (-2.6, -0.5),
    "fear": (-2.1, -0.4),
    "fears": (-2.0, -0.4),
    "worry": (-1.8, -0.35),
    "worries": (-1.8, -0.35),
    "concern": (-1.2, -0.25),
    "concerns": (-1.2, -0.25),
    "risk": (-1.1, -0.2),
    "risks": (-1.1, -0.2),
    "bad": (-2.5, -0.7),
    "worse": (-2.1, -0.5),
    "worst": (-3.1, -0.9),
    "terrible": (-2.6, -0.9),
    "poor": (-2.1, -0.4),
    "negative": (-2.2, -0.4),
    "bearish": (-1.6, -0.3),
    "bankruptcy": (-2.6, -0.5),
    "bankrupt": (-2.6, -0.5),
    "layoffs": (-1.6, -0.3),
    "defect": (-1.4, -0.3),
    "defects": (-1.4, -0.3),
    "recall": (-0.8, -0.2),
    "recalls": (-0.8, -0.2),
    "downgrade": (-1.5, -0.3),
    "downgraded": (-1.5, -0.3),
    "investigation": (-0.9, -0.2),
    "warning": (-1.4, -0.3),
    "warns": (-1.3, -0.25),
    "failure": (-2.3, -0.45),
    "fails": (-1.9, -0.4),
    "failed": (-2.0, -0.45),
}

# Damping constant of the published valence normalisation s / sqrt(s^2 + 15).
VALENCE_DAMPING = 15.0
