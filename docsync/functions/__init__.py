"""docsync.functions"""
