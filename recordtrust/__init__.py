"""Record-reliability scoring as Spark jobs.

Submitted versions of a record are joined to the master they were merged into, every
attribute is labelled as agreeing, disagreeing or unknown, the labels are profiled per
submitter and per logo, one forest per attribute is trained on the profile rates, and
reliability reports come out per submitter and per version.
"""
