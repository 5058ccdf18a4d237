"""Handing results over: tables of a workbook folder, text reports, label files, databases, manifests."""
