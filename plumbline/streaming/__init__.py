"""Intentionally empty: every run is a batch over one or more reporting anchors.

"""
