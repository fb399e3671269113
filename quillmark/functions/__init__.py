"""quillmark.functions"""
