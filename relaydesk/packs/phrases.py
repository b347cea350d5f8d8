"""Phrases that the support pack is tried on."""

from __future__ import annotations

# what people might write, so that every rule of the support pack is met by some and missed by others
SUPPORT_PHRASES = (
    "the battery is bulging", "swollen battery again", "it expanded near the battery", "a spark came out of it",
    "I saw smoke and fire", "a burning smell in the room", "battery swollen so bad it cracked open", "my account was hacked",
    "unauthorized login at night", "someone logged into my mail", "they changed my password", "stolen credit card used",
    "someone is buying thousands of coins", "my father died", "need the legacy contact form",
    "I lost my trusted phone number and don't have any other", "shattered front glass", "cracked glass and glass shards",
    "it fell into the pool", "liquid and corrosion inside", "greyed out wifi switch", "a green line on the oled",
    "vertical line across the display", "the volume button fell out", "sim tray stuck", "unresponsive to touch",
    "black camera preview only", "kernel panic each hour", "error 4013 when restoring", "charged me three times",
    "charged twice for one song", "refund request 12 days ago", "you promised a refund", "threatening legal action now",
    "ask my lawyer", "already tried restarting", "done that 4 times", "this is unacceptable", "you refused to help",
    "how much is the repair", "broken glass, what to bring", "screen repair and the speaker", "low power mode and magsafe",
    "draining fast and overheating, hot", "it shut off while charging", "ios 11.2 update", "watchos 4.1 is updating, install it",
    "macos sierra crashes in a boot loop", "apple logo, then freezing", "verifying update for ever",
    "system storage and other storage full, keyboard lag", "apple id and icloud passcode", "two-factor 2fa verification code",
    "locked, cannot unlock, iforgot page", "activation lock with find my keychain", "bluetooth, cellular and no sim",
    "airpods and a hotspot", "searching...now on lte, 3g or 4g", "airdrop by gps while roaming, new carrier and sim card",
    "charged me $20 for a subscription", "apple music and app store purchase", "itunes.com/bill on my credit card",
    "apple pay billing declined", "an in-app purchase", "cracked and shattered, water damage", "dropped, genius bar or applecare",
    "microphone and taptic and button fell off", "padlock and orientation lock", "how do I delete apps", "a trade-in for true tone",
    "face id and screen recording", "do not disturb, move to ios, screenshot", "night shift, safari and notes, offload",
    "iphone 8 plus", "iphone x and ipad pro", "apple watch series 3", "macbook air with beats studio", "a lawsuit and water",
    "it may explode", "nothing special",
)
