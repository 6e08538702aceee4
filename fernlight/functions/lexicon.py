"""Word lists of the finance lexicon and the market tags."""

# A word given with and without blanks around it counts twice.
BULLISH = ("buy", "bullish", "breakout", "upside", "rally", "long", "target", "strong", "accumulate", "support", "तेजी", "तेजी", "खरीद", "खरीदो", "ऊपर", "उछाल", "bull", "recovery", "outperform", "green")
BEARISH = ("sell", "bearish", "breakdown", "downside", "crash", "short", "weak", "fall", "गिरावट", "गिरावट", "मंदी", "बेचो", "नीचे", "loss", "red", "underperform")
RISK = ("sure shot", "guaranteed", "operator", "pump", "upper circuit", "multibagger", "100%", "double money", "jackpot", "inside news", "fixed target")
NEGATIONS = ("not", "no", "never", "नहीं", "मत")

#: In order of preference.
MARKETS = ("banknifty", "nifty50", "sensex", "intraday")

ACCESS_MARKERS = ("rate limit exceeded", "verify your identity", "unusual activity", "automated requests", "account is locked", "temporarily limited")
