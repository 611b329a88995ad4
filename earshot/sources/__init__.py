"""Tables in and out: scans, codecs, written intermediates, saved indexes and models."""
